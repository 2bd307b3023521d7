"""Typed document catalogue: ``{TypeName: {"path": ..., "format": ...}}``."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from .sequence import read_documents, read_sequence_documents
from .text import read_keyed_json


def read_json_config(spark: SparkSession, path: str) -> dict:
    """A small JSON configuration file (frame, manifest) from any Hadoop path."""
    text = spark.read.text(path, wholetext=True).first()
    if text is None:
        raise ValueError(f"empty configuration file: {path}")
    return json.loads(text[0])


def load_catalogue(
    spark: SparkSession, manifest: Mapping[str, Mapping[str, str]] | str, sep: str = "\t"
) -> dict[str, DataFrame]:
    """One document set per type. Formats: ``text`` (keyed JSON lines),
    ``parquet`` (``uri``/``doc`` columns); anything else is a sequence file. An
    entry may say ``"unique": true`` (see ``unique_types``)."""
    if isinstance(manifest, str):
        manifest = read_json_config(spark, manifest)
    out: dict[str, DataFrame] = {}
    for name, spec in manifest.items():
        fmt = spec.get("format", "text")
        if fmt == "text":
            out[name] = read_keyed_json(spark, spec["path"], sep)
        elif fmt == "parquet":
            out[name] = read_documents(spark, spec["path"])
        else:
            out[name] = read_sequence_documents(spark, spec["path"])
    return out


def unique_types(manifest: Mapping[str, Mapping]) -> list[str]:
    """The types whose entry declares that no uri repeats."""
    return [name for name, spec in manifest.items() if spec.get("unique") is True]
