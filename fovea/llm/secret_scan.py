"""Operator 4: secrets by fixed patterns, and by automata learned from what the patterns found.

The patterns give labelled credentials. For each kind (and for ordinary strings of the same alphabet)
a sample of them becomes a prefix tree with counts; states whose onward frequencies do not differ
significantly (Hoeffding bound) are merged, which leaves a small probabilistic automaton. Every other string
that could be a credential is then scored: by how much more likely its format is under the best
credential automaton than under that of ordinary strings. Strings that a credential automaton explains
about as well as the ordinary one are kept off the ordinary side, or a format of many unlabelled
credentials would count as ordinary.

The automata are fitted on the driver from at most `per_kind` strings of each kind, those with the least
hash; finding and scoring covers all of every text.

Defined cases: a null text is empty; the empty text has no spans; a null id is kept; repeated rows
give repeated rows; without labelled credentials no span is added; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import statistics
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fovea.llm.common import materialize, prepare, whole_text

#: The base patterns, their kinds in order, and the least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex")
LEAST_ASSIGN, LEAST_ACCESS = 8, 16
KEYWORDS = ("passw", "secret", "token", "api")

#: A string of this alphabet and length may be a credential, given a digit in it.
LEAST_CANDIDATE = 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % LEAST_CANDIDATE)
MARKS = "+/_.=-"
DIGIT = re.compile(r"[0-9]")
#: Bounds of the sample that the automata are learned from: strings of a kind, and characters of a string.
PER_KIND = 1_000
LONGEST_LEARNED = 128
#: Natural logarithm of how much likelier a credential's format must be than an ordinary one's.
LEAST_RATIO = 8.0
#: A string is not ordinary from this ratio on, unless it is explained worse than labelled ones by so many deviations.
DOUBTFUL_RATIO, DOUBTFUL_DEVIATIONS = -3.0, 4.0
CLASSES = str.maketrans(
    {chr(c): k for k, low, high in (("0", 48, 57), ("A", 65, 90), ("a", 97, 102), ("g", 103, 122))
     for c in range(low, high + 1)}
)


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, credential) of the base patterns, by start, then kind."""
    found = []
    if ":" in text or "=" in text:
        small = text.lower()
        if any(word in small for word in KEYWORDS):
            for m in ASSIGN.finditer(text):
                if len(m[2]) >= LEAST_ASSIGN:
                    found.append((m.start(), 0, m.end(), m[2]))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= LEAST_ACCESS:
                found.append((m.start(), 1, m.end(), m[0]))
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, str]]:
    """(start, end, string) of possible credentials: what the base spans leave of runs of the alphabet.

    Where a span is cut out of a run, one mark next to it separates the two and belongs to neither.
    """
    out = []
    spans = sorted((s, e) for s, _, e, _ in base)
    k = 0
    reach = -1

    def add(start: int, end: int, cut_before: bool, cut_after: bool) -> None:
        start += cut_before and start < end and text[start] in MARKS
        end -= cut_after and start < end and text[end - 1] in MARKS
        if end - start >= LEAST_CANDIDATE and DIGIT.search(text, start, end):
            out.append((start, end, text[start:end]))

    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        at, cut = max(start, reach), reach > start
        while k < len(spans) and spans[k][0] < end:
            add(at, spans[k][0], cut, True)
            reach = max(reach, spans[k][1])
            at, cut = max(at, reach), cut or reach > start
            k += 1
        add(at, end, cut, False)
    return out


@dataclass
class Automaton:
    """A deterministic probabilistic automaton over character classes."""

    seen: list[int] = field(default_factory=lambda: [0])
    ends: list[int] = field(default_factory=lambda: [0])
    steps: list[dict[str, tuple[int, int]]] = field(default_factory=lambda: [{}])

    def log_likelihood(self, string: str) -> float:
        """Of the string's classes and its end; a symbol never seen counts half a time."""
        state, total = 0, 0.0
        for symbol in string.translate(CLASSES):
            step = self.steps[state].get(symbol)
            if step is None:
                total += math.log(0.5 / (self.seen[state] + 8))
            else:
                total += math.log(step[1] / (self.seen[state] + 0.5))
                state = step[0]
        return total + math.log((self.ends[state] + 0.5) / (self.seen[state] + 1))


def infer(strings: list[str], alpha: float = 0.05) -> Automaton:
    """Merge the states of the strings' prefix tree that are statistically compatible."""
    seen, ends, steps = [0], [0], [{}]  # steps: symbol -> [state, times]
    for string in strings:
        state = 0
        for symbol in string.translate(CLASSES):
            seen[state] += 1
            step = steps[state].setdefault(symbol, [len(seen), 0])
            step[1] += 1
            if step[0] == len(seen):
                seen.append(0)
                ends.append(0)
                steps.append({})
            state = step[0]
        seen[state] += 1
        ends[state] += 1
    width = math.sqrt(0.5 * math.log(2 / alpha))

    def differ(a: int, n: int, b: int, m: int) -> bool:
        return abs(a / n - b / m) > width * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def compatible(a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            p, q = todo.pop()
            if differ(ends[p], seen[p], ends[q], seen[q]):
                return False
            for symbol in steps[p].keys() | steps[q].keys():
                x, y = steps[p].get(symbol, (None, 0)), steps[q].get(symbol, (None, 0))
                if differ(x[1], seen[p], y[1], seen[q]):
                    return False
                if x[0] is not None and y[0] is not None and x[0] != y[0]:
                    todo.append((x[0], y[0]))
        return True

    def fold(a: int, b: int) -> None:
        """The tree below b goes into a."""
        todo = [(a, b)]
        while todo:
            p, q = todo.pop()
            seen[p] += seen[q]
            ends[p] += ends[q]
            for symbol, (target, times) in steps[q].items():
                if symbol in steps[p]:
                    step = steps[p][symbol]
                    step[1] += times
                    todo.append((step[0], target))
                else:
                    steps[p][symbol] = [target, times]

    red = [0]
    while True:
        blue = {t: (s, x) for s in red for x, (t, _) in steps[s].items() if t not in red}
        if not blue:
            break
        state = max(blue, key=lambda t: (seen[t], -t))
        parent, symbol = blue[state]
        for other in red:
            if compatible(other, state):
                steps[parent][symbol][0] = other
                fold(other, state)
                break
        else:
            red.append(state)
    number = {state: k for k, state in enumerate(red)}
    return Automaton(
        [seen[s] for s in red],
        [ends[s] for s in red],
        [{x: (number[t], n) for x, (t, n) in steps[s].items()} for s in red],
    )


@dataclass
class Formats:
    """Automata of the credential kinds and of ordinary strings."""

    kinds: dict[str, Automaton]
    ordinary: Automaton

    def ratio(self, string: str) -> float:
        """How much likelier the format is as a credential, as a natural logarithm."""
        if not self.kinds:
            return -math.inf
        best = max(a.log_likelihood(string) for a in self.kinds.values())
        return best - self.ordinary.log_likelihood(string)

    def added(self, found: list[tuple[int, int, str]], least: float) -> list[tuple[int, int, float]]:
        scored = ((s, e, self.ratio(x)) for s, e, x in found)
        return [x for x in scored if x[2] >= least]


def infer_ordinary(strings: list[str], kinds: dict[str, Automaton], labelled: dict[str, list[str]]) -> Automaton:
    """Automaton of the strings that do not look like credentials.

    One looks like a credential if an automaton of `kinds` explains it as well per symbol as its own
    `labelled` strings, and not much worse than the ordinary automaton does. Without those the ordinary
    one is inferred again, until none is left.
    """

    def per_symbol(kind: str, string: str) -> float:
        return kinds[kind].log_likelihood(string) / (len(string) + 1)

    least = {}
    for kind, known in labelled.items():
        usual = [per_symbol(kind, x) for x in known]
        least[kind] = statistics.fmean(usual) - DOUBTFUL_DEVIATIONS * statistics.pstdev(usual)
    explained = {
        x: max((kinds[k].log_likelihood(x) for k in kinds if per_symbol(k, x) >= least[k]), default=-math.inf)
        for x in strings
    }
    while True:
        ordinary = infer(strings)
        left = [x for x in strings if explained[x] - ordinary.log_likelihood(x) < DOUBTFUL_RATIO]
        if len(left) == len(strings):
            return ordinary
        strings = left


FOUND = (
    "array<struct<start: int, kind: int, end: int, value: string>>",
    "array<struct<start: int, end: int, value: string>>",
)


def extract(docs: DataFrame) -> DataFrame:
    """(doc_id, base, candidates) of every row."""
    prepare(docs.sparkSession)
    base_type, candidate_type = (pa.list_(pa.struct(x)) for x in (
        [("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("value", pa.string())],
        [("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())],
    ))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            base = [base_spans(x) for x in texts]
            other = [candidates(x, b) for x, b in zip(texts, base)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([[dict(zip(("start", "kind", "end", "value"), y)) for y in x] for x in base], base_type),
                    pa.array([[dict(zip(("start", "end", "value"), y)) for y in x] for x in other], candidate_type),
                ],
                ["doc_id", "base", "candidates"],
            )

    schema = f"doc_id bigint, base {FOUND[0]}, candidates {FOUND[1]}"
    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(run, schema)


def _sample(strings: DataFrame, per_kind: int, longest: int) -> list[str]:
    """Distinct strings of at most `longest` characters with the least hashes."""
    short = strings.where(F.length("value") <= longest).select("value").distinct()
    rows = short.orderBy(F.xxhash64("value"), "value").limit(per_kind).collect()
    return [row["value"] for row in rows]


def learn(found: DataFrame, per_kind: int = PER_KIND, longest: int = LONGEST_LEARNED) -> Formats:
    """Automata from extracted rows (see `extract`).

    Learned from `per_kind` strings of a kind of at most `longest` characters; all strings are scored, of any length.
    """
    base = found.select(F.inline("base"))
    labelled = {}
    for k, name in enumerate(KINDS):
        strings = _sample(base.where(F.col("kind") == k), per_kind, longest)
        if strings:
            labelled[name] = strings
    kinds = {name: infer(strings) for name, strings in labelled.items()}
    others = _sample(found.select(F.inline("candidates")), per_kind, longest)
    return Formats(kinds, infer_ordinary(others, kinds, labelled))


def score(found: DataFrame, formats: Formats, least: float = LEAST_RATIO) -> DataFrame:
    """Extracted rows with `added`: (start, end, ratio) of the candidates that look like credentials."""
    prepare(found.sparkSession)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("ratio", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.column("candidates").to_pylist():
                strings = [(x["start"], x["end"], x["value"]) for x in row]
                rows.append(
                    [{"start": s, "end": e, "ratio": r} for s, e, r in formats.added(strings, least)]
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("base"), pa.array(rows, kind)],
                ["doc_id", "base", "added"],
            )

    schema = f"doc_id bigint, base {FOUND[0]}, added array<struct<start: int, end: int, ratio: double>>"
    return found.mapInArrow(run, schema)


def span_text(spans: Column) -> Column:
    """kind:start:end of an array of (start, kind number, end), comma-joined."""
    names = F.array(*map(F.lit, (*KINDS, "format")))
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"], x["end"]),
        ),
        ",",
    )


def scan(
    docs: DataFrame, per_kind: int = PER_KIND, least: float = LEAST_RATIO, longest: int = LONGEST_LEARNED
) -> DataFrame:
    """(doc_id, base, added): all spans of all documents; the texts are read once."""
    found = materialize(extract(docs), "secrets")
    return score(found, learn(found, per_kind, longest), least)


def redact(
    docs: DataFrame,
    per_kind: int = PER_KIND,
    least: float = LEAST_RATIO,
    mark: str = "[secret]",
    longest: int = LONGEST_LEARNED,
) -> DataFrame:
    """The documents with every span replaced by `mark`; overlapping spans become one mark.

    Columns stay as they are, but for `text`; a text without spans, or null, stays as it is.
    """
    formats = learn(materialize(extract(docs), "secrets"), per_kind, longest)
    prepare(docs.sparkSession)

    def clean(text: str) -> str:
        base = base_spans(text)
        spans = [(s, e) for s, _, e, _ in base]
        spans += [(s, e) for s, e, _ in formats.added(candidates(text, base), least)]
        if not spans:
            return text
        out, reach = [], 0
        for start, end in sorted(spans):
            if start >= reach:
                out += [text[reach:start], mark]
            reach = max(reach, end)
        return "".join([*out, text[reach:]])

    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x if x is None else clean(x) for x in batch.column(at).to_pylist()]
            yield batch.set_column(at, "text", pa.array(texts, pa.string()))

    return docs.mapInArrow(run, docs.schema)
