"""Token ids of texts by the tokenizers library, each different word looked up once in a batch.

A batch of texts is cut into words and dictionary-encoded by Arrow; only its different words meet a table
of known ones, and the ids are gathered by the words' numbers. New words are cut into parts as the
vocabulary's own pattern does, so that a word with and without its punctuation is merged once, and the
library's merges are run on the parts, many in one call. Byte-level words without white space of their
own need no such cut: the library gets many of them as one text, whose ids tell where each begins, and
those of letters alone not even the library's pattern.

`LowerWords` is for vocabularies that drop white space, make letters small and mark the end of a word;
`ByteWords` for byte-level ones, whose words keep the space before them. Both look into the tokenizer's
description; one of another make gets its texts whole.
"""

from __future__ import annotations

import json
import os
import re
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from fovea.llm.bpe import WORDS, byte_symbols

#: Words and parts that a generation of a worker's tables holds.
CACHED_WORDS, CACHED_PARTS = 300_000, 150_000
#: Parts that are encoded in one text, and words that are cut at a time.
JOINED, CUT_AT_ONCE = 500, 20_000


class Generations:
    """A table of bounded size: what was not asked for while a generation filled up is forgotten with the next."""

    def __init__(self, most: int):
        self.most = most
        self.new, self.old = {}, {}

    def turn(self) -> None:
        if len(self.new) > self.most:
            self.new, self.old = {}, self.new

    def missing(self, keys: set) -> set:
        """Keys of neither generation; those of the old one are taken over."""
        gone = keys.difference(self.new)
        back = self.old.keys() & gone  # goes through the few that are gone, not through a whole generation
        self.new.update(zip(back, map(self.old.__getitem__, back)))
        return gone - back


class WordTable:
    """Ids of words as packed integers; what is shared by both kinds of vocabularies."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        # the same model in memory, without special tokens: words next to each other may spell one that no text has
        self.bare = Tokenizer(self.library.model)
        self.spec = json.loads(self.library.to_str())
        for long in ("vocab", "merges"):
            self.spec["model"].pop(long, None)
        self.vocabulary = self.library.get_vocab()
        self.size = max(self.vocabulary.values()) + 1
        self.type = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.words = Generations(CACHED_WORDS)
        self.parts = Generations(CACHED_PARTS)

    def pack(self, ids) -> bytes:
        return np.asarray(ids, self.type).tobytes()

    def whole(self, text: bytes) -> bytes:
        """Ids of a text by the library alone."""
        return self.pack(self.library.encode(text.decode(), add_special_tokens=False).ids)

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Packed ids of each text; `texts` are strings without nulls, a few MB of them."""
        self.words.turn()
        self.parts.turn()
        aside = self.aside(texts)
        if aside.any():
            kept = pa.array(~aside)
            plain = iter(self.gather(self.cut(texts.filter(kept))) if not aside.all() else [])
            return [
                self.set_aside(texts[i].as_py().encode()) if out else next(plain)
                for i, out in enumerate(aside.tolist())
            ]
        return self.gather(self.cut(texts))

    def gather(self, pieces: pa.ListArray) -> list[bytes]:
        """Packed ids of each list of words."""
        coded = pieces.flatten().dictionary_encode()
        codes = coded.indices.to_numpy()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = self.words.missing(set(words))
        if new:
            self.learn(list(new))
        found = list(map(self.words.new.__getitem__, words))
        flat = np.frombuffer(b"".join(found), self.type)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.type.itemsize
        first = np.cumsum(sizes) - sizes
        n = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(n)])
        # places among the ids of one batch fit in 32 bits
        at = np.repeat((first[codes] - ends[:-1]).astype(np.int32), n)
        at += np.arange(len(at), dtype=np.int32)
        packed = flat[at].tobytes()
        offsets = pieces.offsets.to_numpy()
        edges = (ends[offsets - offsets[0]] * self.type.itemsize).tolist()
        return [packed[a:b] for a, b in zip(edges, edges[1:])]

    def ids_of_parts(self, parts: list[str], opens: np.ndarray | None, closes: np.ndarray | None) -> None:
        """Encode parts joined by the bare tokenizer's delimiter; ids that open or close a part are known."""
        for low in range(0, len(parts), JOINED * 100):
            some = parts[low : low + JOINED * 100]
            texts = [self.signs(some[k : k + JOINED]) for k in range(0, len(some), JOINED)]
            found = self.bare.encode_batch_fast(texts, add_special_tokens=False)
            ids = np.concatenate([np.array(x.ids, self.type) for x in found])
            if opens is not None:
                edges = np.append(np.nonzero(opens[ids])[0], len(ids))
            else:
                edges = np.append(0, np.nonzero(closes[ids])[0] + 1)
            packed, edges = ids.tobytes(), (edges * self.type.itemsize).tolist()
            self.parts.new.update(zip(some, [packed[a:b] for a, b in zip(edges, edges[1:])], strict=True))

    def join_parts(self, words: list[bytes], parts: list[str]) -> None:
        """Ids of words from all their parts in a row, in which a line feed ends each word."""
        ids = list(map(self.parts.new.__getitem__, parts))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        ends = np.cumsum(sizes)
        stop = np.array(parts, object) == "\n"
        packed, edges = b"".join(ids), [0, *ends[stop].tolist()]
        self.words.new.update(zip(words, [packed[a:b] for a, b in zip(edges, edges[1:])], strict=True))


class LowerWords(WordTable):
    """Vocabularies that know neither white space nor capitals and mark the last symbol of a part."""

    #: The pattern of this family, and what it is for small printable ASCII, line by line.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    ASCII_PARTS = re.compile(r"\n|'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\na-z0-9]+")
    PLAIN = re.compile(rb"[!-@\[-~]+")

    def __init__(self, path: str):
        super().__init__(path)
        from tokenizers import pre_tokenizers

        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        suffix = self.spec["model"].get("end_of_word_suffix") or ""
        text = json.dumps(self.spec["pre_tokenizer"]) + json.dumps(self.spec["normalizer"])
        self.by_word = json.dumps(self.PATTERN) in text and '"Lowercase"' in text and suffix != ""
        printable = [chr(i) for i in range(33, 127) if not chr(i).isupper()]
        self.by_part = self.by_word and all(x + suffix in self.vocabulary for x in printable)
        self.closes = np.zeros(self.size, bool)
        self.closes[[i for name, i in self.vocabulary.items() if suffix and name.endswith(suffix)]] = True

    @staticmethod
    def signs(parts: list[str]) -> str:
        return " ".join(parts)

    def aside(self, texts: pa.Array) -> np.ndarray:
        """Texts that may hold the name of a special token, whose letters must stay as they are."""
        if not self.by_word:
            return np.ones(len(texts), bool)
        return pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)

    set_aside = WordTable.whole

    def cut(self, texts: pa.Array) -> pa.ListArray:
        return pc.ascii_split_whitespace(pc.ascii_lower(texts)).cast(pa.list_(pa.binary()))

    def learn(self, words: list[bytes]) -> None:
        plain = self.PLAIN.fullmatch
        if not self.by_part:
            other, words = words, []
        else:
            other = [word for word in words if not plain(word)]
            words = [word for word in words if plain(word)]
        self.parts.new["\n"] = b""
        for low in range(0, len(words), CUT_AT_ONCE):
            some = words[low : low + CUT_AT_ONCE]
            parts = self.ASCII_PARTS.findall(b"\n".join([*some, b""]).decode())
            self.ids_of_parts(list(self.parts.missing(set(parts))), None, self.closes)
            self.join_parts(some, parts)
        found = self.library.encode_batch_fast([x.decode() for x in other], add_special_tokens=False)
        self.words.new.update((word, self.pack(x.ids)) for word, x in zip(other, found))


class ByteWords(WordTable):
    """Byte-level vocabularies. A text is cut before spaces and line feeds, where the library would part it
    too, unless white space stands on both their sides: only a space joins what follows it. Texts with three
    white-space characters in a row or two at the end, or with such beyond ASCII, are cut by the pattern.
    Full stops and commas between an ASCII letter or digit and white space are a part of their own, and a word here.
    Words without a space before them, and those that begin with a line feed, are told apart by marks.
    """

    FIRST, FEED = b"\xff", b"\xfe"
    STOP = rb"([0-9A-Za-z])([.,])([ \n])"
    AWKWARD = (
        r"[\t-\r ][\t-\r ](?:[\t-\r ]|$)|[\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    )
    #: Bytes of ASCII, Latin-1 and Latin Extended-A letters, and of Cyrillic ones up to U+047F.
    LETTERS = np.zeros(256, bool)
    LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xC3, 0xC4, 0xC5, 0xD0, 0xD1, *range(0x80, 0xC0)]] = True

    def __init__(self, path: str):
        super().__init__(path)
        from tokenizers import Tokenizer, pre_tokenizers

        self.plain = Tokenizer(self.library.model)
        if self.library.pre_tokenizer is not None:
            self.plain.pre_tokenizer = self.library.pre_tokenizer
        symbols = byte_symbols()
        # parts are joined by a zero byte, which none of those that are joined holds
        self.bare.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(symbols[0])
        cut, model = self.spec["pre_tokenizer"] or {}, self.spec["model"]
        self.by_word = (
            cut.get("type") == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"]
            and self.spec["normalizer"] is None and model["type"] == "BPE"
            and not model["end_of_word_suffix"] and not model["continuing_subword_prefix"]
        )
        self.special = [x["content"] for x in self.spec["added_tokens"]]
        self.symbols = np.array([ord(x) for x in symbols], "<u2")
        self.opens = np.zeros(self.size, bool)
        self.opens[[i for name, i in self.vocabulary.items() if name.startswith(symbols[32])]] = True
        self.pattern = regex.compile(WORDS).findall

    def signs(self, parts: list[str]) -> str:
        """Parts as the vocabulary's printable signs of their bytes, joined."""
        return self.signs_of("\0".join(parts).encode())

    def signs_of(self, raw: bytes) -> str:
        return self.symbols[np.frombuffer(raw, np.uint8)].tobytes().decode("utf-16-le")

    def aside(self, texts: pa.Array) -> np.ndarray:
        if not self.by_word:
            return np.ones(len(texts), bool)
        out = pc.match_substring_regex(texts, self.AWKWARD)
        for name in self.special:
            out = pc.or_(out, pc.match_substring(texts, name))
        return out.to_numpy(zero_copy_only=False)

    def set_aside(self, text: bytes) -> bytes:
        if not self.by_word or any(name.encode() in text for name in self.special):
            return self.whole(text)
        parts = self.pattern(text.decode())
        self.learn_parts(parts)
        return b"".join(map(self.parts.new.__getitem__, parts))

    def cut(self, texts: pa.Array) -> pa.ListArray:
        marked = pc.replace_substring_regex(
            texts.cast(pa.binary()), pattern=self.STOP, replacement=rb"\1 " + self.FIRST + rb"\2\3"
        )
        marked = pc.binary_join_element_wise(self.FIRST, marked, b"")
        marked = pc.replace_substring(marked, pattern=b"\n", replacement=b" " + self.FEED)
        return pc.split_pattern(marked, pattern=b" ")

    def of_letters(self, words: list[bytes]) -> np.ndarray:
        """Words that are letters alone, of the kinds above; no word has a space."""
        raw = np.frombuffer(b" ".join([*words, b""]), np.uint8)
        other = ~self.LETTERS[raw]
        # the signs of multiplication and division lie among the letters
        other[:-1] |= (raw[:-1] == 0xC3) & ((raw[1:] == 0x97) | (raw[1:] == 0xB7))
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        # the space that ends a word is no letter
        return (np.add.reduceat(other, np.cumsum(sizes) - sizes, dtype=np.int64) == 1) & (sizes > 1)

    def learn(self, words: list[bytes]) -> None:
        space = re.compile(rb"[\t-\r\xfe\xff]").search
        lead = {self.FIRST: b"", self.FEED: b"\n"}
        one = self.of_letters(words)
        letters, rest = list(compress(words, one.tolist())), list(compress(words, (~one).tolist()))
        is_odd = [not word or space(word) is not None for word in rest]
        odd = [word for word, out in zip(rest, is_odd) if out]
        plain = [word for word, out in zip(rest, is_odd) if not out]
        texts = [lead[w[:1]] + w[1:] if w[:1] in lead else b" " + w for w in odd]
        cut = [self.pattern(text.replace(self.FEED, b"\n").decode()) for text in texts]
        self.learn_parts([part for parts in cut for part in parts])
        get = self.parts.new.__getitem__
        self.words.new.update((word, b"".join(map(get, parts))) for word, parts in zip(odd, cut))
        for some, one in ((letters, True), (plain, False)):
            for low in range(0, len(some), CUT_AT_ONCE):
                self.learn_plain(some[low : low + CUT_AT_ONCE], one)

    def learn_plain(self, words: list[bytes], one: bool) -> None:
        """Words without white space: many as one text, in which only an id that begins a word begins with a space.

        Words of which each is `one` part are given as signs, like parts.
        """
        some = [words[k : k + JOINED] for k in range(0, len(words), JOINED)]
        if one:
            texts = [self.signs_of(b" " + b"\0 ".join(x)) for x in some]
        else:
            texts = [b" ".join([b"", *x]).decode() for x in some]
        found = (self.bare if one else self.plain).encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(x.ids, self.type) for x in found])
        edges = np.append(np.nonzero(self.opens[ids])[0], len(ids)) * self.type.itemsize
        packed, edges = ids.tobytes(), edges.tolist()
        self.words.new.update(zip(words, [packed[a:b] for a, b in zip(edges, edges[1:])], strict=True))

    def learn_parts(self, parts: list[str]) -> None:
        new = self.parts.missing(set(parts))
        single = [x for x in new if x[0] != " " or "\0" in x or x.isspace()]
        self.ids_of_parts(list(new.difference(single)), self.opens, None)
        rest = [x for x in single if "\0" not in x]
        found = self.bare.encode_batch_fast([self.signs([x]) for x in rest], add_special_tokens=False)
        self.parts.new.update((part, self.pack(x.ids)) for part, x in zip(rest, found))
        self.parts.new.update((x, self.whole(x.encode())) for x in single if "\0" in x)


_loaded: dict[tuple[type, str], WordTable] = {}


def word_table(kind: type[WordTable], path: str) -> WordTable:
    """This worker's table of a vocabulary."""
    if (kind, path) not in _loaded:
        _loaded[kind, path] = kind(path)
    return _loaded[kind, path]
