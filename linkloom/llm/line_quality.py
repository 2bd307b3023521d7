"""Quality rules: cross-document line frequency.

Lines are normalised and hashed; for each host the *distinct* documents that hold
a line are counted, lines above the host's limit are removed, and documents that
lose too much by it are rejected, together with those that fail the base rules.

Documents are told apart by all their distinct normalised lines, so exact copies of one
document count once, and every document that differs in a line counts: near copies do, too.
So are the documents of a host, of which a share is the limit; those without a line are one.

One Arrow pass turns each text into numbers and line hashes; counting and joining
is Spark's work on those narrow rows. Both counts combine before they shuffle, and
the join back to the documents spreads lines that very many documents hold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, shipped, stage, tidy

#: The characters that separate words, and those that count as symbols.
SEPARATORS = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
_NORMAL = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", b"abcdefghijklmnopqrstuvwxyz000000000")


@dataclass(frozen=True)
class LineSettings:
    min_words: int = 50
    max_repeat_percent: int = 50
    min_documents: int = 20  # a line in at most so many distinct documents of its host stays
    max_share: float = 0.05  # and one in at most this share of the host's distinct documents
    min_left_words: int = 20  # of a text after its lines were removed
    min_left_share: float = 0.5


def line_hash(line: bytes) -> int | None:
    """60 bits of the MD5 of the line in lower case, digits as 0, single spaces; None without a word."""
    words = line.translate(_NORMAL).split()
    return int(hashlib.md5(b" ".join(words)).hexdigest()[:15], 16) if words else None


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window which the text has twice or more."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    # two steps of pairs keep the codes small for any vocabulary
    _, pair = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)
    _, window, count = np.unique(pair[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True)
    twice = count[window] > 1
    if not twice.any():
        return 0
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= twice
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, int, int, int, int, list[int], list[int]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the text's
    distinct line hashes in ascending order with the words of all their lines."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    gaps = len(raw) - len(raw.translate(None, SEPARATORS))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    duplicates = 0
    lines: dict[int, int] = {}
    for line in raw.split(b"\n"):
        key = line_hash(line)
        if key is not None:
            duplicates += line in seen
            seen.add(line)
            lines[key] = lines.get(key, 0) + len(line.split())
    keys = sorted(lines)
    return len(words), len(text) - gaps, symbols, duplicates, repeated_words(words), keys, [lines[k] for k in keys]


_MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def profile_documents(docs: DataFrame, text: str = "text", host: str = "source", keep: list[str] | None = None) -> DataFrame:
    """One row per document: ``_row`` (its number), ``_host``, the columns ``keep``
    as struct ``_doc``, the measures, ``_lines`` and ``_line_words``; written to the
    shared folder, so row numbers stay. A null host is the host ''."""
    columns = docs.columns if keep is None else keep
    rows = docs.select(
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("_host"), F.col(text).alias("_text"), F.struct(*columns).alias("_doc")
    )
    doc_type = rows.schema["_doc"].dataType.simpleString()
    schema = "_host string, _doc " + doc_type + "".join(f", {m} long" for m in _MEASURES) + ", _lines array<long>, _line_words array<long>"

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure(t.as_py()) for t in batch.column("_text")]
            measures = [pa.array([f[i] for f in found], pa.int64()) for i in range(5)]
            lists = [pa.array([f[i] for f in found], pa.list_(pa.int64())) for i in (5, 6)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_host"), batch.column("_doc"), *measures, *lists], ["_host", "_doc", *_MEASURES, "_lines", "_line_words"]
            )

    return stage(shipped(rows).mapInArrow(run, schema).withColumn("_row", F.monotonically_increasing_id()), "line-profiles")


def _line_rows(profiles: DataFrame) -> DataFrame:
    """One row per document and distinct line; ``_document`` is a 64-bit hash of all the
    document's distinct lines, equal for exact copies."""
    rows = profiles.select(
        "_row", "_host", F.xxhash64("_lines").alias("_document"), F.explode(F.arrays_zip("_lines", "_line_words")).alias("_l")
    )
    return rows.select("_row", "_host", "_document", F.col("_l._lines").alias("_line"), F.col("_l._line_words").alias("_words"))


def frequent_lines(profiles: DataFrame, settings: LineSettings) -> tuple[DataFrame, int]:
    """``_host, _line, rows, documents`` of the lines above their host's limit, and the number of all line rows."""
    counts = (
        _line_rows(profiles).groupBy("_host", "_line", "_document").agg(F.count(F.lit(1)).alias("rows"))
        .groupBy("_host", "_line").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("documents"))
    )
    # both sides of the share are distinct documents: copies of one text make neither more of them
    each = profiles.groupBy("_host", F.xxhash64("_lines").alias("_document")).agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("_lines")).alias("line_rows"))
    hosts = each.groupBy("_host").agg(F.count(F.lit(1)).alias("of"), F.sum("rows").alias("rows"), F.sum("line_rows").alias("line_rows"))
    totals = hosts.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("docs"), F.coalesce(F.sum("line_rows"), F.lit(0)).alias("lines")).first()
    common = counts.where(F.col("documents") > settings.min_documents).withColumnRenamed("rows", "line_rows")
    limited = attach(common, hosts.select("_host", "of", "rows"), ["_host"], "rows", totals["docs"], ["_line"]).withColumnRenamed("line_rows", "rows")
    found = limited.where(F.col("documents") > F.col("_found.of") * settings.max_share).drop("_found")
    return stage(found, "frequent-lines"), totals["lines"]


def judge_profiles(profiles: DataFrame, settings: LineSettings) -> DataFrame:
    """``profiles`` with ``words_left`` and ``removed_lines`` (hashes; at most the
    document's own distinct lines), ``base_failed`` and ``kept``."""
    frequent, total = frequent_lines(profiles, settings)
    hits = attach(_line_rows(profiles), frequent, ["_host", "_line"], "rows", total, ["_row"]).where(F.col("_found").isNotNull())
    lost = hits.groupBy("_row").agg(F.sum("_words").alias("_lost"), F.collect_list("_line").alias("removed_lines"))
    judged = profiles.join(lost, "_row", "left")
    left = F.col("n_words") - F.coalesce("_lost", F.lit(0))
    base = (F.col("n_words") < settings.min_words) | (100 * F.col("n_repeat_words") > settings.max_repeat_percent * F.col("n_words"))
    depleted = (F.col("words_left") < settings.min_left_words) | (F.col("words_left") < settings.min_left_share * F.col("n_words"))
    return judged.withColumns({"words_left": left, "base_failed": base}).withColumn("kept", ~F.col("base_failed") & ~depleted)


def judge_documents(docs: DataFrame, keep: list[str], settings: LineSettings = LineSettings(), text: str = "text", host: str = "source") -> DataFrame:
    """One row per document: the columns ``keep``, the base measures, ``words_left``,
    ``base_failed`` and ``kept``.

    A null or empty text has no words and fails. Repeated rows are documents each.
    Columns not named are not read. An empty table gives an empty result."""
    judged = judge_profiles(profile_documents(docs, text, host, keep), settings)
    return judged.select(*[F.col("_doc")[c].alias(c) for c in keep], *_MEASURES, "words_left", "base_failed", "kept")


def clean_documents(docs: DataFrame, settings: LineSettings = LineSettings(), text: str = "text", host: str = "source", chars: str | None = "n_chars") -> DataFrame:
    """The kept documents with all their columns, their frequent lines removed from
    ``text`` and ``chars`` (if there is such a column) set to the new length."""
    judged = judge_profiles(profile_documents(docs, text, host), settings).where("kept")
    rows = judged.select(F.col("_doc")[text].alias("_text"), F.coalesce("removed_lines", F.array().cast("array<long>")).alias("_remove"), "_doc")
    doc_type = rows.schema["_doc"].dataType.simpleString()

    @tidy
    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for whole, remove in zip(batch.column("_text"), batch.column("_remove").to_pylist()):
                whole = whole.as_py()
                if remove:
                    gone = set(remove)
                    whole = b"\n".join(x for x in whole.encode().split(b"\n") if line_hash(x) not in gone).decode()
                out.append(whole)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), batch.column("_doc")], ["_text", "_doc"])

    cleaned = rows.mapInArrow(strip, f"_text string, _doc {doc_type}")
    changed = {text: F.col("_text")} | ({chars: F.char_length("_text").cast(docs.schema[chars].dataType)} if chars in docs.columns else {})
    return cleaned.select(*[changed.get(c, F.col("_doc")[c]).alias(c) for c in docs.columns])
