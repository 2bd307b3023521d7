"""File-to-file jobs, one per entry point of the original tool set.

Each job reads document sets (``text`` = keyed JSON lines, ``sequence`` =
Hadoop sequence file, ``parquet`` = ``uri``/``doc`` columns), runs one engine
operator and writes the result. Run them from Python or through
``spark-submit -m``-style ``python -m linkloom.jobs <job> ...``.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from .operators import basic_merge, clean, deduplicate, link_merge, self_links
from .plans import compute_frames_increment, frame_documents
from .session import scratch_scope
from .sources import (
    load_catalogue, read_delimited_base, read_documents, read_json_config,
    read_keyed_json, read_sequence_documents, unique_types, write_documents, write_keyed_json, write_sequence_documents,
)


def read_set(spark: SparkSession, path: str, fmt: str = "text", sep: str = "\t") -> DataFrame:
    if fmt == "text":
        return read_keyed_json(spark, path, sep)
    if fmt == "parquet":
        return read_documents(spark, path)
    return read_sequence_documents(spark, path)


def write_set(docs: DataFrame, path: str, fmt: str = "text", sep: str = "\t") -> None:
    if fmt == "text":
        write_keyed_json(docs, path, sep)
    elif fmt == "parquet":
        write_documents(docs, path)
    else:
        write_sequence_documents(docs, path)


def basic_merge_job(spark, input_path, input_format, json_path, base_path, base_format, output_path,
                    output_format="text", sep="\t", num_partitions=None, max_refs=None, unique=False, unique_base=None):
    docs = read_set(spark, input_path, input_format, sep)
    base = read_set(spark, base_path, base_format, sep)
    write_set(basic_merge(docs, json_path, base, max_refs=max_refs, num_partitions=num_partitions,
                          unique_uris=unique, unique_base=unique if unique_base is None else unique_base),
              output_path, output_format, sep)


def link_merge_job(spark, input_path, input_format, json_path, base_path, base_format, links_path, links_format,
                   output_path, output_format="text", remove: Sequence[str] = (), sep="\t", num_partitions=None,
                   unique=False, unique_base=None):
    docs = read_set(spark, input_path, input_format, sep)
    base = read_set(spark, base_path, base_format, sep)
    links = read_set(spark, links_path, links_format, sep)
    write_set(link_merge(docs, json_path, base, links, remove, num_partitions=num_partitions,
                         unique_uris=unique, unique_base=unique if unique_base is None else unique_base),
              output_path, output_format, sep)


def clean_job(spark, input_path, input_format, json_path, base_path, base_format, output_path,
              output_format="text", sep="\t", num_partitions=None, unique=False, unique_base=None):
    docs = read_set(spark, input_path, input_format, sep)
    base = read_set(spark, base_path, base_format, sep)
    write_set(clean(docs, json_path, base, num_partitions=num_partitions, unique_uris=unique,
                    unique_base=unique if unique_base is None else unique_base),
              output_path, output_format, sep)


def dedup_job(spark, input_path, input_format, json_path, output_path, output_format="text", sep="\t"):
    write_set(deduplicate(read_set(spark, input_path, input_format, sep), json_path), output_path, output_format, sep)


def frame_job(spark, frame_path, manifest_path, output_path, output_format="text", sep="\t",
              num_partitions=None, max_refs=None):
    frame = read_json_config(spark, frame_path)
    manifest = read_json_config(spark, manifest_path)
    catalogue = load_catalogue(spark, manifest, sep)
    write_set(frame_documents(frame, catalogue, max_refs=max_refs, num_partitions=num_partitions,
                              unique_types=unique_types(manifest)),
              output_path, output_format, sep)


def increment_job(spark, frames_path, frames_format, state_root, output_path, output_format="text", sep="\t",
                  num_partitions=None, unique=False):
    out = compute_frames_increment(spark, read_set(spark, frames_path, frames_format, sep), state_root,
                                   num_partitions=num_partitions, unique_uris=unique)
    write_set(out, output_path, output_format, sep)


def self_links_job(spark, input_path, input_format, output_path, sep="\t"):
    links = self_links(read_set(spark, input_path, input_format, sep))
    links.select("doc").selectExpr("to_json(doc) AS value").write.text(output_path)


def base_file_job(spark, input_path, output_path, sep="\t", rejected_path=None):
    docs, rejected = read_delimited_base(spark, input_path, sep)
    write_keyed_json(docs, output_path, sep)
    if rejected_path:
        rejected.write.text(rejected_path)


def convert_job(spark, input_path, input_format, output_path, output_format, sep="\t"):
    write_set(read_set(spark, input_path, input_format, sep), output_path, output_format, sep)


def main(argv: Sequence[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="linkloom.jobs")
    p.add_argument("--separator", default="\t")
    p.add_argument("--num-partitions", type=int, default=None)
    p.add_argument("--max-refs", type=int, default=None)
    p.add_argument("--remove", default="", help="comma separated attributes removed on link merge")
    p.add_argument("--unique", action="store_true", help="no uri repeats in the input and base sets of a job")
    p.add_argument("--unique-input", action="store_true", help="no uri repeats in the input set")
    p.add_argument("--unique-base", action="store_true", help="no uri repeats in the base set")
    p.add_argument("job", choices=["merge", "link-merge", "clean", "dedup", "frame", "increment", "self-links",
                                   "base-file", "convert"])
    p.add_argument("args", nargs="+")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"linkloom-{a.job}").getOrCreate()
    with scratch_scope(spark):  # a job leaves its output only
        run_job(spark, a)


def run_job(spark: SparkSession, a: argparse.Namespace) -> None:
    sep, n, x = a.separator, a.num_partitions, a.args
    unique = {"unique": a.unique or a.unique_input, "unique_base": a.unique or a.unique_base}
    if a.job == "merge":
        basic_merge_job(spark, *x[:6], *(x[6:7] or ["text"]), sep=sep, num_partitions=n, max_refs=a.max_refs, **unique)
    elif a.job == "link-merge":
        remove = [r for r in a.remove.split(",") if r]
        link_merge_job(spark, *x[:8], *(x[8:9] or ["text"]), remove=remove, sep=sep, num_partitions=n, **unique)
    elif a.job == "clean":
        clean_job(spark, *x[:6], *(x[6:7] or ["text"]), sep=sep, num_partitions=n, **unique)
    elif a.job == "dedup":
        dedup_job(spark, *x[:4], *(x[4:5] or ["text"]), sep=sep)
    elif a.job == "frame":
        frame_job(spark, *x[:3], *(x[3:4] or ["text"]), sep=sep, num_partitions=n, max_refs=a.max_refs)
    elif a.job == "increment":
        increment_job(spark, *x[:4], *(x[4:5] or ["text"]), sep=sep, num_partitions=n, unique=unique["unique"])
    elif a.job == "self-links":
        self_links_job(spark, *x[:3], sep=sep)
    elif a.job == "base-file":
        base_file_job(spark, *x[:2], sep=sep, rejected_path=x[2] if len(x) > 2 else None)
    else:
        convert_job(spark, *x[:4], sep=sep)


if __name__ == "__main__":
    main(sys.argv[1:])
