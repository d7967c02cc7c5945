"""Object-store access through Hadoop settings instead of credentials in a URI, and mounted names for stores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fovea.operators.inspect import lookup_row


def store_settings(
    bucket: str, access_key: str, secret_key: str, endpoint: str | None = None
) -> dict[str, str]:
    """The s3a settings of one bucket."""
    prefix = f"fs.s3a.bucket.{bucket}"
    settings = {f"{prefix}.access.key": access_key, f"{prefix}.secret.key": secret_key}
    if endpoint:
        settings[f"{prefix}.endpoint"] = endpoint
    return settings


def store_settings_from_table(
    credentials: DataFrame,
    user: str,
    bucket: str,
    user_col: str = "User name",
    access_col: str = "Access key ID",
    secret_col: str = "Secret access key",
    endpoint: str | None = None,
) -> dict[str, str]:
    """Look up both keys of `user` in one job; the values are neither shown nor logged."""
    row = lookup_row(credentials, user_col, user, [access_col, secret_col])
    return store_settings(bucket, row[access_col], row[secret_col], endpoint)


def use_store(spark: SparkSession, settings: dict[str, str]) -> None:
    """Apply the settings to readers and writers of this session."""
    for key, value in settings.items():
        spark.conf.set(key, value)


def store_uri(bucket: str, *parts: str) -> str:
    return "/".join([f"s3a://{bucket}", *(part.strip("/") for part in parts)])


def mount_settings(name: str, links: dict[str, str]) -> dict[str, str]:
    """Settings of a mount table: below `viewfs://<name>`, each link (like `/training`) leads to a URI.

    Paths keep the mounted name wherever they appear, so that jobs and their results do not depend on
    the store behind it. A bucket's own settings (`store_settings`) apply to what is behind a link.
    """
    if not links:
        raise ValueError("a mount table needs a link")
    prefix = f"fs.viewfs.mounttable.{name}.link"
    settings = {f"{prefix}./{link.strip('/')}": target for link, target in links.items()}
    # a file system that was opened before would keep the links of that time
    return {**settings, "fs.viewfs.impl.disable.cache": "true"}


def mount_uri(name: str, *parts: str) -> str:
    return "/".join([f"viewfs://{name}", *(part.strip("/") for part in parts)])


def mounts(spark: SparkSession, name: str) -> dict[str, str]:
    """The links of a mount table that is in force in this session."""
    prefix = f"fs.viewfs.mounttable.{name}.link."
    return {key.removeprefix(prefix): value for key, value in spark.conf.getAll.items() if key.startswith(prefix)}
