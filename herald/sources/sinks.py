"""Message and payload output."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_messages(messages: DataFrame, path: str, fmt: str = "parquet",
                   mode: str = "errorifexists") -> None:
    """One row per contact; a file per contact would not scale."""
    messages.select("member_id", "subject", "html").write.mode(mode).format(fmt).save(path)


def write_payloads(payloads: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON document per line."""
    payloads.select("payload").write.mode(mode).text(path)
