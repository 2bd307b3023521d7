"""Registered queries over the driver tables, and their SQL oracles.

Each query turns rows of the given tables into documents ``(uri, doc)`` with
Spark, runs one engine job over all of them and reads flat scalar columns back
out of the resulting documents. The oracle computes the same columns in plain
SQL over the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom import (
    basic_merge, clean, compute_frames_increment, deduplicate, expand_lists, filter_by_class, frame_documents, increment_plan,
    link_merge, links_from_documents, load_catalogue, load_table_documents, one_per_uri, parse_delimited_base,
    parse_keyed_lines, project_keys, read_keyed_json, resolve_links, self_links, split_by_classes, write_keyed_json,
)
from linkloom.functions import as_object, fingerprint, key_hex, objects_at, refs_at, to_variant, uri_of, with_variant
from linkloom.operators import Slot, merge_slots, union_documents
from linkloom.operators.skew import SkewSettings
from linkloom.plans import begin_increment, read_state
from linkloom.session import shared_path
from linkloom.sources import (
    format_keyed_lines, read_sequence_documents, split_keyed_lines, text_to_sequence, write_documents, write_sequence_documents,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def key(prefix: str, c: str) -> Column:
    return F.concat(F.lit(prefix), F.col(c).cast("string"))


def vstr(s: str | Column) -> Column:
    return (F.lit(s) if isinstance(s, str) else s).cast("variant")


def get(path: str, typ: str, doc: str = "doc") -> Column:
    return F.try_variant_get(F.col(doc), path, typ)


# ---------------------------------------------------------------- documents

def customer_docs(spark, d) -> DataFrame:
    c = table(spark, d, "customer")
    uri = key("customer/", "c_custkey")
    return c.select(uri.alias("uri"), to_variant(F.struct(
        F.lit("Customer").alias("a"), uri.alias("uri"), "c_name", "c_acctbal", "c_mktsegment", "c_nationkey",
        key("nation/", "c_nationkey").alias("nation"),
    )).alias("doc"))


def nation_docs(spark, d) -> DataFrame:
    n = table(spark, d, "nation")
    uri = key("nation/", "n_nationkey")
    return n.select(uri.alias("uri"), to_variant(F.struct(
        F.lit("Nation").alias("a"), uri.alias("uri"), "n_name", "n_nationkey", "n_regionkey",
        key("region/", "n_regionkey").alias("region"),
    )).alias("doc"))


def region_docs(spark, d) -> DataFrame:
    r = table(spark, d, "region")
    uri = key("region/", "r_regionkey")
    return r.select(uri.alias("uri"), to_variant(F.struct(F.lit("Region").alias("a"), uri.alias("uri"), "r_name")).alias("doc"))


def part_docs(spark, d) -> DataFrame:
    """Part documents; ``a`` is absent, the class is in ``@type``."""
    p = table(spark, d, "part")
    uri = key("part/", "p_partkey")
    return p.select(uri.alias("uri"), to_variant(F.struct(
        F.lit("schema:Product").alias("@type"), uri.alias("uri"), "p_name", "p_brand", "p_size",
    )).alias("doc"))


def order_docs(spark, d, customer_ref: Column | None = None) -> DataFrame:
    o = table(spark, d, "orders")
    uri = key("order/", "o_orderkey")
    ref = customer_ref if customer_ref is not None else vstr(key("customer/", "o_custkey"))
    return o.select(uri.alias("uri"), to_variant(F.struct(
        F.lit("Order").alias("a"), uri.alias("uri"), "o_totalprice", "o_orderstatus", ref.alias("hasCustomer"),
    )).alias("doc"))


LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
              "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def lines_per_order(spark, d, element: Callable[[Column], Column]) -> DataFrame:
    """``(l_orderkey, items)``: one VARIANT array per order, elements built by
    ``element(line struct)`` and ordered by the full line row."""
    li = table(spark, d, "lineitem")
    grouped = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(*LINE_ORDER))).alias("ls"))
    return grouped.select("l_orderkey", F.to_variant_object(F.transform("ls", element)).alias("items"))


def part_uri(s: Column) -> Column:
    """Lines that were returned name a part that does not exist."""
    return F.concat(F.when(s["l_returnflag"] == "R", F.lit("gone/")).otherwise(F.lit("part/")), s["l_partkey"].cast("string"))


def part_ref(s: Column, as_object_when: Column) -> Column:
    uri = part_uri(s)
    obj = to_variant(F.struct(uri.alias("uri"), s["l_quantity"].alias("qty")))
    return F.when(as_object_when, obj).otherwise(vstr(uri))


def order_parts_docs(spark, d) -> DataFrame:
    items = lines_per_order(spark, d, lambda s: part_ref(s, s["l_linestatus"] == "O"))
    uri = key("order/", "l_orderkey")
    return items.select(uri.alias("uri"), to_variant(F.struct(uri.alias("uri"), F.col("items").alias("parts"))).alias("doc"))


def exploded(df: DataFrame, arr: Column, *cols: Column) -> DataFrame:
    return df.select("uri", F.explode(arr).alias("e")).select("uri", *cols)


def merged_part_columns() -> list[Column]:
    e = F.col("e")
    return [
        uri_of(e).alias("part_uri"),
        F.try_variant_get(e, "$.p_name", "string").alias("p_name"),
        F.try_variant_get(e, "$.qty", "double").alias("qty"),
    ]


def as_variant_array(c: Column) -> Column:
    return c.try_cast("array<variant>")


# ---------------------------------------------------------------- queries

def q_basic_merge_object(spark, d):
    role_ref = F.when(F.col("o_orderstatus") == "F", vstr(key("customer/", "o_custkey"))).otherwise(
        to_variant(F.struct(key("customer/", "o_custkey").alias("uri"), F.lit("buyer").alias("role"))))
    # both tables have a key, so neither set is de-duplicated
    return merged_customer(basic_merge(order_docs(spark, d, role_ref), "hasCustomer", customer_docs(spark, d),
                                       unique_uris=True, unique_base=True))


def merged_customer(out):
    return out.select("uri", get("$.hasCustomer.c_name", "string").alias("c_name"),
                      get("$.hasCustomer.c_mktsegment", "string").alias("c_mktsegment"),
                      get("$.hasCustomer.c_acctbal", "double").alias("c_acctbal"),
                      get("$.hasCustomer.role", "string").alias("role"),
                      get("$.hasCustomer.uri", "string").alias("customer_uri"))


def q_basic_merge_partitioned(spark, d):
    """With a partition count, and a set whose documents come twice."""
    docs = order_docs(spark, d)
    return merged_customer(basic_merge(docs.unionByName(docs), "hasCustomer", customer_docs(spark, d), num_partitions=7))


def q_basic_merge_salted(spark, d):
    """Every customer named more than twice counts as hot."""
    slot = Slot("hasCustomer", customer_docs(spark, d))
    return merged_customer(merge_slots(order_docs(spark, d), [slot], skew=SkewSettings(threshold=2)))


def q_basic_merge_keyless(spark, d):
    """Documents without a key go past the merge."""
    docs = order_docs(spark, d).withColumn("uri", F.when(get("$.o_orderstatus", "string") != "P", F.col("uri")))
    out = basic_merge(docs, "hasCustomer", customer_docs(spark, d))
    return out.select("uri", get("$.uri", "string").alias("doc_uri"), get("$.hasCustomer.c_name", "string").alias("c_name"))


def q_basic_merge_unmatched(spark, d):
    role_ref = F.when(F.col("o_orderstatus") == "F", vstr(key("customer/", "o_custkey"))).otherwise(
        to_variant(F.struct(key("customer/", "o_custkey").alias("uri"), F.lit("buyer").alias("role"))))
    base = customer_docs(spark, d).where(get("$.c_mktsegment", "string") == "BUILDING")
    out = basic_merge(order_docs(spark, d, role_ref), "hasCustomer", base)
    return out.select("uri", get("$.hasCustomer.c_name", "string").alias("c_name"),
                      as_object(get("$.hasCustomer", "variant")).isNotNull().alias("ref_is_object"),
                      uri_of(get("$.hasCustomer", "variant")).alias("customer_uri"))


def q_basic_merge_array(spark, d):
    out = basic_merge(order_parts_docs(spark, d), "parts", part_docs(spark, d))
    return exploded(out, as_variant_array(get("$.parts", "variant")), *merged_part_columns())


def q_basic_merge_capped(spark, d):
    out = basic_merge(order_parts_docs(spark, d), "parts", part_docs(spark, d), max_refs=2)
    return exploded(out, as_variant_array(get("$.parts", "variant")), *merged_part_columns())


def q_basic_merge_deep(spark, d):
    def line(s):
        return to_variant(F.struct(vstr(part_uri(s)).alias("part"), s["l_quantity"].alias("qty")))

    items = lines_per_order(spark, d, line)
    uri = key("order/", "l_orderkey")
    docs = items.select(uri.alias("uri"), to_variant(F.struct(
        uri.alias("uri"), F.struct(F.col("items").alias("lines"), F.lit("ship").alias("kind")).alias("shipment"),
    )).alias("doc"))
    out = basic_merge(docs, "shipment.lines.part", part_docs(spark, d))
    e = F.col("e")
    return exploded(out, as_variant_array(get("$.shipment.lines", "variant")),
                    uri_of(F.try_variant_get(e, "$.part", "variant")).alias("part_uri"),
                    F.try_variant_get(e, "$.part.p_name", "string").alias("p_name"),
                    F.try_variant_get(e, "$.qty", "double").alias("qty"))


def nation_alias_links(spark, d) -> DataFrame:
    n = table(spark, d, "nation")
    alias = n.select(key("nat/", "n_nationkey").alias("s"), key("nation/", "n_nationkey").alias("b"))
    ident = n.select(key("nation/", "n_nationkey").alias("s"), key("nation/", "n_nationkey").alias("b"))
    link_docs = alias.unionByName(ident).select(F.col("s").alias("uri"), to_variant(F.struct(
        F.col("s").alias("uri"),
        F.array(F.struct(F.col("b").alias("uri"), F.lit(1.0).alias("score"))).alias("matches"),
    )).alias("doc"))
    return link_docs


def customer_nation_ref_docs(spark, d) -> DataFrame:
    c = table(spark, d, "customer")
    uri = key("customer/", "c_custkey")
    alias = key("nat/", "c_nationkey")
    ref = F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), vstr(alias)).otherwise(
        to_variant(F.struct(alias.alias("uri"), F.lit("n").alias("note"))))
    return c.select(uri.alias("uri"), to_variant(F.struct(uri.alias("uri"), "c_name", ref.alias("nation"))).alias("doc"))


def _link_merge_out(out):
    return out.select("uri", get("$.nation.uri", "string").alias("nation_uri"),
                      get("$.nation.n_name", "string").alias("n_name"),
                      get("$.nation.note", "string").alias("note"))


def q_link_merge(spark, d):
    return _link_merge_out(link_merge(customer_nation_ref_docs(spark, d), "nation", nation_docs(spark, d),
                                      nation_alias_links(spark, d)))


def q_link_merge_remove(spark, d):
    return _link_merge_out(link_merge(customer_nation_ref_docs(spark, d), "nation", nation_docs(spark, d),
                                      nation_alias_links(spark, d), remove=["note"]))


def q_link_merge_absent_base(spark, d):
    """Some sources are also linked to a base uri that sorts first but does not exist."""
    n = table(spark, d, "nation").where(F.col("n_nationkey") % 2 == 0)
    absent = n.select(key("nat/", "n_nationkey").alias("uri"), to_variant(F.struct(
        key("nat/", "n_nationkey").alias("uri"), F.array(F.struct(key("absent/", "n_nationkey").alias("uri"))).alias("matches"),
    )).alias("doc"))
    links = nation_alias_links(spark, d).unionByName(absent)
    return _link_merge_out(link_merge(customer_nation_ref_docs(spark, d), "nation", nation_docs(spark, d), links))


def q_link_resolve_multi(spark, d):
    """Three links per supplier, one of them to a base document that does not exist."""
    s = table(spark, d, "supplier")
    uri = key("supplier-nation/", "s_suppkey")
    targets = F.array(key("nation/", "s_nationkey"), F.concat(F.lit("nation/"), ((F.col("s_nationkey") + 1) % 25).cast("string")),
                      key("absent/", "s_nationkey"))
    links = s.select(uri.alias("source_uri"), F.explode(targets).alias("base_uri"))
    out = resolve_links(links, nation_docs(spark, d))
    return out.select("uri", get("$.n_name", "string").alias("n_name"))


def q_link_resolve(spark, d):
    s = table(spark, d, "supplier")
    link_docs = s.select(key("supplier-nation/", "s_suppkey").alias("uri"), to_variant(F.struct(
        key("supplier-nation/", "s_suppkey").alias("uri"),
        F.array(F.struct(key("nation/", "s_nationkey").alias("uri"))).alias("matches"),
    )).alias("doc"))
    out = resolve_links(links_from_documents(link_docs), nation_docs(spark, d))
    return out.select("uri", get("$.n_name", "string").alias("n_name"), get("$.n_regionkey", "int").alias("n_regionkey"))


def q_identity_links(spark, d):
    c = table(spark, d, "customer")
    uri = key("customer/", "c_custkey")
    target = F.when(F.col("c_acctbal") < 0, uri).otherwise(key("account/", "c_custkey"))
    link_docs = c.select(uri.alias("uri"), to_variant(F.struct(
        uri.alias("uri"), F.array(F.struct(target.alias("uri"))).alias("matches"))).alias("doc"))
    return links_from_documents(link_docs)


def q_clean_overlay(spark, d):
    c = table(spark, d, "customer")
    o = table(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"))
    curi = key("customer/", "c_custkey")
    embedded = to_variant(F.struct(curi.alias("uri"), "c_name", "c_mktsegment", F.lit(True).alias("stale")))
    uri = key("order/", "o_orderkey")
    docs = o.select(uri.alias("uri"), to_variant(F.struct(uri.alias("uri"), embedded.alias("customer"))).alias("doc"))
    seg = F.when(F.col("c_acctbal") < 0, F.lit("REVIEW")).otherwise(F.col("c_mktsegment"))
    full = to_variant(F.struct(curi.alias("uri"), "c_name", seg.alias("c_mktsegment"), "c_acctbal"))
    empty = F.to_variant_object(F.create_map().cast("map<string,variant>"))
    base = c.select(curi.alias("uri"), F.when(F.col("c_nationkey") == 0, empty).otherwise(full).alias("doc"))
    out = clean(docs, "customer", base)
    return out.select("uri", get("$.customer.c_mktsegment", "string").alias("c_mktsegment"),
                      get("$.customer.c_name", "string").alias("c_name"),
                      get("$.customer.stale", "boolean").alias("stale"),
                      get("$.customer.c_acctbal", "double").alias("c_acctbal"))


def q_clean_array(spark, d):
    """Clean an array of embedded part objects; parts with ``p_size > 45``
    have an empty base document, which must leave their entries untouched."""
    def embedded(s):
        uri = F.concat(F.lit("part/"), s["l_partkey"].cast("string"))
        return to_variant(F.struct(uri.alias("uri"), F.lit("stale").alias("p_brand"), s["l_quantity"].alias("qty")))

    items = lines_per_order(spark, d, embedded)
    uri = key("order/", "l_orderkey")
    docs = items.select(uri.alias("uri"), to_variant(F.struct(uri.alias("uri"), F.col("items").alias("parts"))).alias("doc"))
    p = table(spark, d, "part")
    puri = key("part/", "p_partkey")
    empty = F.to_variant_object(F.create_map().cast("map<string,variant>"))
    full = to_variant(F.struct(puri.alias("uri"), "p_name", "p_brand"))
    base = p.select(puri.alias("uri"), F.when(F.col("p_size") > 45, empty).otherwise(full).alias("doc"))
    out = clean(docs, "parts", base)
    e = F.col("e")
    return exploded(out, as_variant_array(get("$.parts", "variant")),
                    F.try_variant_get(e, "$.uri", "string").alias("part_uri"),
                    F.try_variant_get(e, "$.p_brand", "string").alias("p_brand"),
                    F.try_variant_get(e, "$.p_name", "string").alias("p_name"),
                    F.try_variant_get(e, "$.qty", "double").alias("qty"))


def q_dedup_objects(spark, d):
    """Dedup object elements: equal objects are written with different key
    orders (a map and a struct), so equality must be by JSON content."""
    def line(s):
        as_struct = to_variant(F.struct(s["l_partkey"].alias("l_partkey"), s["l_returnflag"].alias("l_returnflag")))
        as_map = F.to_variant_object(F.create_map(F.lit("l_returnflag"), s["l_returnflag"].cast("variant"),
                                                  F.lit("l_partkey"), s["l_partkey"].cast("variant")))
        return F.when(s["l_linestatus"] == "O", as_struct).otherwise(as_map)

    items = lines_per_order(spark, d, line)
    uri = key("order/", "l_orderkey")
    docs = items.select(uri.alias("uri"), to_variant(F.struct(F.struct(F.col("items").alias("lines")).alias("detail"))).alias("doc"))
    out = deduplicate(docs, "detail.lines")
    e = F.col("e")
    return exploded(out, as_variant_array(get("$.detail.lines", "variant")),
                    F.try_variant_get(e, "$.l_partkey", "bigint").alias("l_partkey"),
                    F.try_variant_get(e, "$.l_returnflag", "string").alias("l_returnflag"))


def q_dedup_array(spark, d):
    items = lines_per_order(spark, d, lambda s: s["l_partkey"].cast("variant"))
    uri = key("order/", "l_orderkey")
    docs = items.select(uri.alias("uri"), to_variant(F.struct(
        uri.alias("uri"), F.struct(F.col("items").alias("partkeys")).alias("detail"))).alias("doc"))
    out = deduplicate(docs, "detail.partkeys")
    return exploded(out, as_variant_array(get("$.detail.partkeys", "variant")),
                    F.try_variant_get(F.col("e"), "$", "bigint").alias("l_partkey"))


def q_dedup_top_level(spark, d):
    """Documents that are arrays: each element is treated by itself."""
    items = lines_per_order(spark, d, lambda s: to_variant(F.struct(
        s["l_linenumber"].alias("l_linenumber"), F.array(s["l_partkey"], s["l_suppkey"], s["l_partkey"]).alias("keys"))))
    out = deduplicate(items.select(key("order/", "l_orderkey").alias("uri"), F.col("items").alias("doc")), "keys")
    e = F.col("e")
    return exploded(out, as_variant_array(F.col("doc")), F.try_variant_get(e, "$.l_linenumber", "bigint").alias("l_linenumber"),
                    F.size(as_variant_array(F.try_variant_get(e, "$.keys", "variant"))).alias("n_keys"))


def q_extract_refs(spark, d):
    def ref(s):
        uri = F.concat(F.lit("part/"), s["l_partkey"].cast("string"))
        return (F.when(s["l_linestatus"] == "F", vstr(uri))
                .when(s["l_returnflag"] == "R", to_variant(F.struct(uri.alias("@id"))))
                .otherwise(to_variant(F.struct(uri.alias("uri"), s["l_quantity"].alias("qty")))))

    items = lines_per_order(spark, d, ref)
    uri = key("order/", "l_orderkey")
    docs = items.select(uri.alias("uri"), to_variant(F.struct(F.col("items").alias("lines"))).alias("doc"))
    return docs.select("uri", F.explode(refs_at(F.col("doc"), "lines")).alias("ref"))


def q_extract_objects(spark, d):
    def line(s):
        uri = F.concat(F.lit("part/"), s["l_partkey"].cast("string"))
        return to_variant(F.struct(F.struct(uri.alias("uri"), s["l_quantity"].alias("qty")).alias("part")))

    items = lines_per_order(spark, d, line)
    uri = key("order/", "l_orderkey")
    docs = items.select(uri.alias("uri"), to_variant(F.struct(F.struct(F.col("items").alias("lines")).alias("shipment"))).alias("doc"))
    return exploded(docs, objects_at(F.col("doc"), "shipment.lines.part"),
                    F.try_variant_get(F.col("e"), "$.uri", "string").alias("part_uri"),
                    F.try_variant_get(F.col("e"), "$.qty", "double").alias("qty"))


def q_explicit_projection(spark, d):
    out = project_keys(customer_docs(spark, d), ["a", "uri", "c_name"])
    return out.select("uri", get("$.c_name", "string").alias("c_name"),
                      get("$.c_acctbal", "variant").isNotNull().alias("has_acctbal"),
                      F.size(as_object(F.col("doc"))).alias("n_keys"))


def typed_docs(spark, d) -> DataFrame:
    s = table(spark, d, "supplier")
    suri = key("supplier/", "s_suppkey")
    suppliers = s.select(suri.alias("uri"), to_variant(F.struct(
        F.array(F.lit("Supplier"), F.lit("schema:Organization")).alias("a"), suri.alias("uri"), "s_name")).alias("doc"))
    return union_documents([customer_docs(spark, d), suppliers, part_docs(spark, d), nation_docs(spark, d)])


CLASSES = [
    {"name": "Customer", "uri": "schema:Customer"},
    {"name": "Organization", "uri": "schema:Organization"},
    {"name": "Product", "uri": "schema:Product"},
]


def q_type_filter(spark, d):
    return filter_by_class(typed_docs(spark, d), "Product", "schema:Product").select("uri")


def q_type_split(spark, d):
    parts = split_by_classes(typed_docs(spark, d), CLASSES)
    out = None
    for name, df in parts.items():
        labelled = df.select(F.lit(name).alias("class_name"), "uri")
        out = labelled if out is None else out.unionByName(labelled)
    return out


def q_expand_lists(spark, d):
    items = lines_per_order(spark, d, lambda s: to_variant(F.struct(s["l_partkey"].alias("l_partkey"),
                                                                    s["l_quantity"].alias("l_quantity"))))
    docs = items.select(key("order/", "l_orderkey").alias("uri"), F.col("items").alias("doc"))
    return expand_lists(docs).select("uri", get("$.l_partkey", "bigint").alias("l_partkey"),
                                     get("$.l_quantity", "double").alias("l_quantity"))


NESTED_FRAME = {"@type": "Order", "hasCustomer": {"@type": "Customer", "nation": {"@type": "Nation", "region": {"@type": "Region"}}}}


def order_catalogue(spark, d) -> dict[str, DataFrame]:
    return {"Order": order_docs(spark, d), "Customer": customer_docs(spark, d),
            "Nation": nation_docs(spark, d), "Region": region_docs(spark, d)}


def q_frame_nested(spark, d):
    return nested_columns(frame_documents(NESTED_FRAME, order_catalogue(spark, d), unique_uris=True))


def q_frame_checkpointed(spark, d):
    """Children are written to the shared folder before their parents use them."""
    return nested_columns(frame_documents(NESTED_FRAME, order_catalogue(spark, d), checkpoint_children=True))


def q_frame_manifest(spark, d):
    """The sets are files of three formats that a manifest names."""
    sets = order_catalogue(spark, d)
    folder = shared_path(spark, "sets")
    manifest = {name: {"path": f"{folder}/{name}", "format": fmt}
                for name, fmt in (("Order", "parquet"), ("Customer", "text"), ("Nation", "sequence"), ("Region", "text"))}
    for name, spec in manifest.items():
        write = {"parquet": write_documents, "text": write_keyed_json, "sequence": write_sequence_documents}[spec["format"]]
        write(sets[name], spec["path"])
    return nested_columns(frame_documents(NESTED_FRAME, load_catalogue(spark, manifest)))


def nested_columns(out):
    return out.select("uri", get("$.o_totalprice", "double").alias("o_totalprice"),
                      get("$.hasCustomer.c_name", "string").alias("c_name"),
                      get("$.hasCustomer.nation.n_name", "string").alias("n_name"),
                      get("$.hasCustomer.nation.region.r_name", "string").alias("r_name"))


def q_frame_from_split(spark, d):
    """One mixed document set is split by class into the frame's catalogue."""
    mixed = union_documents(list(order_catalogue(spark, d).values()))
    catalogue = split_by_classes(mixed, [{"name": n, "uri": f"schema:{n}"} for n in ("Order", "Customer", "Nation", "Region")])
    return nested_columns(frame_documents(NESTED_FRAME, catalogue, unique_uris=True))


EXPLICIT_FRAME = {"@type": "Order", "@explicit": True, "o_totalprice": {},
                  "hasCustomer": {"@type": "Customer", "@explicit": True, "c_name": {}}}


def q_frame_explicit(spark, d):
    out = frame_documents(EXPLICIT_FRAME, order_catalogue(spark, d))
    return out.select("uri", get("$.o_totalprice", "double").alias("o_totalprice"),
                      get("$.hasCustomer.c_name", "string").alias("c_name"),
                      F.size(as_object(F.col("doc"))).alias("order_keys"),
                      F.size(as_object(get("$.hasCustomer", "variant"))).alias("customer_keys"))


MULTI_FRAME = {"@type": "Order", "hasCustomer": {"@type": "Customer"}, "parts": {"@type": "Part"}}


def q_frame_multi(spark, d):
    """One frame node embedding two properties (a single multi-slot merge)."""
    o = table(spark, d, "orders")
    items = lines_per_order(spark, d, lambda s: vstr(F.concat(F.lit("part/"), s["l_partkey"].cast("string"))))
    uri = key("order/", "o_orderkey")
    orders = o.join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(uri.alias("uri"), to_variant(F.struct(
        F.lit("Order").alias("a"), uri.alias("uri"), key("customer/", "o_custkey").alias("hasCustomer"),
        F.col("items").alias("parts"))).alias("doc"))
    catalogue = {"Order": orders, "Customer": customer_docs(spark, d), "Part": part_docs(spark, d)}
    out = frame_documents(MULTI_FRAME, catalogue, unique_types=["Customer", "Part"])
    lines = out.select("uri", get("$.hasCustomer.c_name", "string").alias("c_name"),
                       F.explode_outer(as_variant_array(get("$.parts", "variant"))).alias("e"))
    return lines.select("uri", "c_name", uri_of(F.col("e")).alias("part_uri"),
                        F.try_variant_get(F.col("e"), "$.p_brand", "string").alias("p_brand"))


def q_frame_no_embed(spark, d):
    frame = {"@type": "Order", "hasCustomer": {"@type": "Customer", "@embed": False}}
    out = frame_documents(frame, order_catalogue(spark, d))
    return out.select("uri", get("$.hasCustomer", "string").alias("customer_ref"))


def q_self_links(spark, d):
    out = self_links(customer_docs(spark, d))
    return out.select("uri", get("$.uri", "string").alias("link_uri"),
                      get("$.matches[0].uri", "string").alias("match_uri"))


def delimited_lines(spark, d) -> DataFrame:
    """``uri<TAB>name<TAB>segment`` rows from customer, plus one-field rows
    (just a supplier uri) that the reader must reject."""
    c = table(spark, d, "customer").select(
        F.concat_ws("\t", key("customer/", "c_custkey"), "c_name", "c_mktsegment").alias("value"))
    s = table(spark, d, "supplier").select(key("supplier/", "s_suppkey").alias("value"))
    return c.unionByName(s)


def q_base_documents(spark, d):
    docs, _rejected = parse_delimited_base(delimited_lines(spark, d))
    return docs.select("uri", get("$.name", "string").alias("name"), get("$.uri", "string").alias("doc_uri"))


def q_base_documents_rejected(spark, d):
    _docs, rejected = parse_delimited_base(delimited_lines(spark, d))
    return rejected


def q_fingerprint(spark, d):
    c = table(spark, d, "customer")
    uri = key("customer/", "c_custkey")
    docs = c.select(uri.alias("uri"), to_variant(F.struct(
        F.lit("Customer").alias("a"), "c_custkey", "c_mktsegment", "c_name", "c_nationkey", uri.alias("uri"))).alias("doc"))
    return docs.select("uri", key_hex(F.col("uri")).alias("uri_hex"), fingerprint(F.col("doc")).alias("hash"))


def q_fingerprint_numbers(spark, d):
    """A typed document and the same one parsed from text have one fingerprint."""
    c = table(spark, d, "customer")
    uri = key("customer/", "c_custkey")
    typed = with_variant(c.select(uri.alias("uri"), "c_custkey", "c_acctbal", "c_name"), F.struct("c_custkey", "c_acctbal", "c_name"))
    text = F.concat(uri, F.lit('\t{"c_name": "'), F.col("c_name"), F.lit('", "c_custkey": '), F.col("c_custkey").cast("string"),
                    F.lit(".0, \"c_acctbal\": "), F.coalesce(F.col("c_acctbal").cast("decimal(20,2)").cast("string"), F.lit("null")), F.lit("}"))
    known = F.col("c_acctbal").isNotNull()
    parsed = parse_keyed_lines(c.where(known).select(text.alias("value")))
    both = typed.where(known).select("uri", fingerprint(F.col("doc")).alias("a")).join(
        parsed.select("uri", fingerprint(F.col("doc")).alias("b")), "uri")
    return both.select("uri", (F.col("a") == F.col("b")).alias("same"))


def event_docs(spark, d, snapshot: bool = False) -> DataFrame:
    e = table(spark, d, "events")
    value = F.col("value")
    if snapshot:
        e = e.where(F.col("event_type") != "signup")
        value = F.when(F.col("event_type") == "error", value + 1).otherwise(value)
    uri = key("event/", "event_id")
    return e.select(uri.alias("uri"), to_variant(F.struct(
        uri.alias("uri"), "event_type", "user_id", value.alias("value"), "props")).alias("doc"))


def event_increment(spark, d) -> DataFrame:
    old = event_docs(spark, d, snapshot=True)
    state = old.select(key_hex(F.col("uri")).alias("uri_hex"), fingerprint(F.col("doc")).alias("hash"))
    increment, _new_state = increment_plan(event_docs(spark, d), state)
    return increment.select("uri", get("$.event_type", "string").alias("event_type"), "status")


def q_increment_new(spark, d):
    return event_increment(spark, d).where(F.col("status") == "new").select("uri", "event_type")


def q_increment_changed(spark, d):
    return event_increment(spark, d).where(F.col("status") == "changed").select("uri", "event_type")


def q_increment_all(spark, d):
    return event_increment(spark, d)


def q_increment_state(spark, d):
    old = event_docs(spark, d, snapshot=True)
    state = old.select(key_hex(F.col("uri")).alias("uri_hex"), fingerprint(F.col("doc")).alias("hash"))
    _inc, new_state = increment_plan(event_docs(spark, d), state)
    fresh = event_docs(spark, d).select(key_hex(F.col("uri")).alias("uri_hex"), fingerprint(F.col("doc")).alias("fresh"))
    return new_state.join(fresh, "uri_hex", "left").select(
        "uri_hex", (F.col("hash") == F.col("fresh")).alias("up_to_date"))


def q_increment_rounds(spark, d):
    """Two incremental rounds with real state IO under the session's shared
    checkpoint folder: the earlier snapshot fills the state, then the current
    documents return only what is new or changed."""
    root = shared_path(spark, "state")
    compute_frames_increment(spark, event_docs(spark, d, snapshot=True), root).count()
    out = compute_frames_increment(spark, event_docs(spark, d), root)
    return out.select("uri", get("$.event_type", "string").alias("event_type"))


def q_increment_duplicate_keys(spark, d):
    """Every document comes twice, and so does every state row."""
    old = event_docs(spark, d, snapshot=True)
    state = old.select(key_hex(F.col("uri")).alias("uri_hex"), fingerprint(F.col("doc")).alias("hash"))
    now = event_docs(spark, d)
    increment, _new_state = increment_plan(now.unionByName(now), state.unionByName(state))
    return increment.select("uri", get("$.event_type", "string").alias("event_type"), "status")


def q_increment_three_rounds(spark, d):
    """Three rounds with every document twice: the state has one row per key, and
    what the last round found (nothing) comes as further rows."""
    root = shared_path(spark, "state")
    docs = event_docs(spark, d)
    docs = docs.unionByName(docs)
    for _ in range(3):
        found = compute_frames_increment(spark, docs, root)
    state = read_state(spark, root).groupBy("uri_hex").agg(F.count(F.lit(1)).alias("rows"))
    return state.unionByName(found.select(F.col("uri").alias("uri_hex"), F.lit(-1).cast("long").alias("rows")))


def _state_rows(spark, root: str, **columns: Column) -> DataFrame:
    return read_state(spark, root).select(F.decode(F.unhex("uri_hex"), "UTF-8").alias("uri"), *[c.alias(n) for n, c in columns.items()])


def q_increment_overlapping(spark, d):
    """Two rounds that read the same (empty) state: the current documents are committed
    first, so the round with the earlier ones is lost, runs again on the new state and
    finds what differs from it. Both are in the state."""
    root = shared_path(spark, "state")
    early = event_docs(spark, d, snapshot=True)
    first = begin_increment(spark, early, root)
    second = begin_increment(spark, event_docs(spark, d), root).commit()
    if first.commit() is not None:
        raise AssertionError("an overtaken round was committed")
    first = compute_frames_increment(spark, early, root)
    kind = get("$.event_type", "string").alias("event_type")
    found = second.select("uri", kind, F.lit("second").alias("writer")).unionByName(first.select("uri", kind, F.lit("first").alias("writer")))
    return found.unionByName(_state_rows(spark, root, event_type=F.lit(None).cast("string"), writer=F.lit("state")))


def events_by_part(spark, d, parts: int) -> DataFrame:
    """The events' documents with the ``part`` that their number is in, written once in a
    folder per part: a round reads its parts, not all events."""
    path = shared_path(spark, "events-by-part")
    part = F.split_part("uri", F.lit("/"), F.lit(2)).cast("bigint") % parts
    docs = event_docs(spark, d).withColumn("part", part)
    docs.write.partitionBy("part").parquet(path)
    return spark.read.schema(docs.schema).parquet(path)


def q_increment_many_rounds(spark, d):
    """40 rounds, each with a 40th of the events and the documents of the round before
    once more: several snapshots are written, and each event is found in one round."""
    root = shared_path(spark, "state")
    rounds = 40
    docs, found = events_by_part(spark, d, rounds), None
    for i in range(rounds):
        mine = docs.where(F.col("part").isin(i, i - 1)).select("uri", "doc")
        now = compute_frames_increment(spark, mine, root, unique_uris=True).select("uri", F.lit(i).alias("round"))
        found = now if found is None else found.unionByName(now)
    return found.unionByName(_state_rows(spark, root, round=F.lit(-1)))


def q_one_per_uri(spark, d):
    o = table(spark, d, "orders")
    docs = o.select(key("customer/", "o_custkey").alias("uri"),
                    to_variant(F.struct("o_orderkey", "o_orderstatus")).alias("doc"))
    return one_per_uri(docs).select("uri", get("$.o_orderkey", "bigint").alias("o_orderkey"),
                                    get("$.o_orderstatus", "string").alias("o_orderstatus"))


def q_text_round_trip(spark, d):
    lines = format_keyed_lines(customer_docs(spark, d))
    back = parse_keyed_lines(lines)
    return back.select("uri", get("$.c_name", "string").alias("c_name"), get("$.c_acctbal", "double").alias("c_acctbal"),
                       get("$.nation", "string").alias("nation"))


def customer_columns(docs):
    return docs.select("uri", get("$.c_name", "string").alias("c_name"), get("$.c_acctbal", "double").alias("c_acctbal"),
                       get("$.nation", "string").alias("nation"))


def q_text_files(spark, d):
    path = shared_path(spark, "lines")
    write_keyed_json(customer_docs(spark, d), path)
    return customer_columns(read_keyed_json(spark, path))


def q_sequence_files(spark, d):
    lines, sequence = shared_path(spark, "lines"), shared_path(spark, "sequence")
    write_keyed_json(customer_docs(spark, d), lines)
    text_to_sequence(spark, lines, sequence)
    return customer_columns(read_sequence_documents(spark, sequence))


def q_keyed_lines_rejected(spark, d):
    """Each line is a document or handed back with the reason: customers of nation 1
    are cut off, those of nation 2 have neither a key nor a uri."""
    c = table(spark, d, "customer")
    nation = F.col("c_nationkey")
    value = (F.when(nation == 1, F.concat(key("customer/", "c_custkey"), F.lit('\t{"cut')))
             .when(nation == 2, F.concat(F.lit('{"c_custkey": '), F.col("c_custkey").cast("string"), F.lit("}")))
             .otherwise(F.concat(key("customer/", "c_custkey"), F.lit('\t{"n": 1, "n": 2}'))))
    docs, rejected = split_keyed_lines(c.select(value.alias("value")))
    return docs.select(F.col("uri").alias("value"), get("$.n", "string").alias("reason")).unionByName(rejected)


def q_stored_text_unescaped(spark, d):
    """``props`` stored with escaped quotes and with a letter as ``\\x6b``."""
    e = table(spark, d, "events")
    stored = F.replace(F.replace(F.col("props"), F.lit("k"), F.lit("\\x6b")), F.lit('"'), F.lit('\\"'))
    docs = load_table_documents(spark, e.select("event_id", stored.alias("stored")), "event_id", "stored", escaped=True)
    return docs.select("uri", get("$.k", "bigint").alias("k"))


def q_table_documents(spark, d):
    docs = load_table_documents(spark, table(spark, d, "events"), "event_id", "props")
    return docs.select("uri", get("$.k", "bigint").alias("k"))


QUERIES: dict[str, Query] = {
    "basic_merge_object": q_basic_merge_object,
    "basic_merge_unmatched": q_basic_merge_unmatched,
    "basic_merge_partitioned": q_basic_merge_partitioned,
    "basic_merge_salted": q_basic_merge_salted,
    "basic_merge_keyless": q_basic_merge_keyless,
    "basic_merge_array": q_basic_merge_array,
    "basic_merge_capped": q_basic_merge_capped,
    "basic_merge_deep": q_basic_merge_deep,
    "link_merge": q_link_merge,
    "link_merge_remove": q_link_merge_remove,
    "link_merge_absent_base": q_link_merge_absent_base,
    "link_resolve": q_link_resolve,
    "link_resolve_multi": q_link_resolve_multi,
    "identity_links": q_identity_links,
    "clean_overlay": q_clean_overlay,
    "clean_array": q_clean_array,
    "dedup_array": q_dedup_array,
    "dedup_objects": q_dedup_objects,
    "dedup_top_level": q_dedup_top_level,
    "extract_refs": q_extract_refs,
    "extract_objects": q_extract_objects,
    "explicit_projection": q_explicit_projection,
    "type_filter": q_type_filter,
    "type_split": q_type_split,
    "expand_lists": q_expand_lists,
    "frame_nested": q_frame_nested,
    "frame_checkpointed": q_frame_checkpointed,
    "frame_manifest": q_frame_manifest,
    "frame_from_split": q_frame_from_split,
    "frame_explicit": q_frame_explicit,
    "frame_multi": q_frame_multi,
    "frame_no_embed": q_frame_no_embed,
    "self_links": q_self_links,
    "base_documents": q_base_documents,
    "base_documents_rejected": q_base_documents_rejected,
    "fingerprint": q_fingerprint,
    "fingerprint_numbers": q_fingerprint_numbers,
    "increment_new": q_increment_new,
    "increment_changed": q_increment_changed,
    "increment_all": q_increment_all,
    "increment_state": q_increment_state,
    "increment_rounds": q_increment_rounds,
    "increment_duplicate_keys": q_increment_duplicate_keys,
    "increment_three_rounds": q_increment_three_rounds,
    "increment_overlapping": q_increment_overlapping,
    "increment_many_rounds": q_increment_many_rounds,
    "one_per_uri": q_one_per_uri,
    "text_round_trip": q_text_round_trip,
    "text_files": q_text_files,
    "sequence_files": q_sequence_files,
    "keyed_lines_rejected": q_keyed_lines_rejected,
    "stored_text_unescaped": q_stored_text_unescaped,
    "table_documents": q_table_documents,
}


# ---------------------------------------------------------------- oracles

def _k(prefix: str, c: str) -> str:
    return f"('{prefix}' || CAST({c} AS VARCHAR))"


_LINE_ORDER_SQL = ", ".join(LINE_ORDER)
_PART_URI_SQL = "(CASE WHEN l.l_returnflag = 'R' THEN 'gone/' ELSE 'part/' END || CAST(l.l_partkey AS VARCHAR))"

ORACLES: dict[str, str] = {
    "basic_merge_object": f"""
        SELECT {_k('order/', 'o.o_orderkey')} AS uri, c.c_name, c.c_mktsegment, c.c_acctbal,
               CASE WHEN o.o_orderstatus <> 'F' THEN 'buyer' END AS role,
               CASE WHEN c.c_custkey IS NOT NULL OR o.o_orderstatus <> 'F' THEN {_k('customer/', 'o.o_custkey')} END AS customer_uri
        FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey""",
    "basic_merge_unmatched": f"""
        SELECT {_k('order/', 'o.o_orderkey')} AS uri, c.c_name,
               (c.c_custkey IS NOT NULL OR o.o_orderstatus <> 'F') AS ref_is_object,
               {_k('customer/', 'o.o_custkey')} AS customer_uri
        FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey AND c.c_mktsegment = 'BUILDING'""",
    "basic_merge_array": f"""
        SELECT {_k('order/', 'l.l_orderkey')} AS uri, {_PART_URI_SQL} AS part_uri, p.p_name,
               CASE WHEN l.l_linestatus = 'O' THEN l.l_quantity END AS qty
        FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey AND l.l_returnflag <> 'R'""",
    "basic_merge_capped": f"""
        WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER_SQL}) AS rn FROM lineitem),
             k AS (SELECT DISTINCT l_orderkey, {_PART_URI_SQL} AS ref FROM l WHERE rn <= 2)
        SELECT {_k('order/', 'l.l_orderkey')} AS uri, {_PART_URI_SQL} AS part_uri,
               CASE WHEN k.l_orderkey IS NOT NULL THEN p.p_name END AS p_name,
               CASE WHEN l.l_linestatus = 'O' THEN l.l_quantity END AS qty
        FROM l LEFT JOIN k ON k.l_orderkey = l.l_orderkey AND k.ref = {_PART_URI_SQL}
               LEFT JOIN part p ON p.p_partkey = l.l_partkey AND l.l_returnflag <> 'R'""",
    "basic_merge_deep": f"""
        SELECT {_k('order/', 'l.l_orderkey')} AS uri, {_PART_URI_SQL} AS part_uri, p.p_name, l.l_quantity AS qty
        FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey AND l.l_returnflag <> 'R'""",
    "link_merge": f"""
        SELECT {_k('customer/', 'c.c_custkey')} AS uri, {_k('nation/', 'n.n_nationkey')} AS nation_uri, n.n_name,
               CASE WHEN c.c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN 'n' END AS note
        FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey""",
    "link_merge_remove": f"""
        SELECT {_k('customer/', 'c.c_custkey')} AS uri, {_k('nation/', 'n.n_nationkey')} AS nation_uri, n.n_name,
               CAST(NULL AS VARCHAR) AS note
        FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey""",
    "link_resolve": f"""
        SELECT {_k('supplier-nation/', 's.s_suppkey')} AS uri, n.n_name, n.n_regionkey
        FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey""",
    "identity_links": f"""
        SELECT {_k('customer/', 'c_custkey')} AS source_uri, {_k('account/', 'c_custkey')} AS base_uri
        FROM customer WHERE NOT coalesce(c_acctbal < 0, false)""",
    "clean_overlay": f"""
        SELECT {_k('order/', 'o.o_orderkey')} AS uri,
               CASE WHEN c.c_nationkey = 0 THEN c.c_mktsegment WHEN c.c_acctbal < 0 THEN 'REVIEW' ELSE c.c_mktsegment END AS c_mktsegment,
               c.c_name, true AS stale,
               CASE WHEN c.c_nationkey = 0 THEN NULL ELSE c.c_acctbal END AS c_acctbal
        FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey""",
    "clean_array": f"""
        SELECT {_k('order/', 'l.l_orderkey')} AS uri, {_k('part/', 'l.l_partkey')} AS part_uri,
               CASE WHEN p.p_size > 45 OR p.p_partkey IS NULL THEN 'stale' ELSE p.p_brand END AS p_brand,
               CASE WHEN p.p_size > 45 THEN NULL ELSE p.p_name END AS p_name,
               l.l_quantity AS qty
        FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey""",
    "dedup_objects": f"SELECT DISTINCT {_k('order/', 'l_orderkey')} AS uri, l_partkey, l_returnflag FROM lineitem",
    "dedup_array": f"SELECT DISTINCT {_k('order/', 'l_orderkey')} AS uri, l_partkey FROM lineitem",
    "extract_refs": f"SELECT {_k('order/', 'l_orderkey')} AS uri, {_k('part/', 'l_partkey')} AS ref FROM lineitem",
    "extract_objects": f"""
        SELECT {_k('order/', 'l_orderkey')} AS uri, {_k('part/', 'l_partkey')} AS part_uri, l_quantity AS qty FROM lineitem""",
    "explicit_projection": f"""
        SELECT {_k('customer/', 'c_custkey')} AS uri, c_name, false AS has_acctbal, CAST(3 AS INTEGER) AS n_keys FROM customer""",
    "type_filter": f"SELECT {_k('part/', 'p_partkey')} AS uri FROM part",
    "type_split": f"""
        SELECT 'Customer' AS class_name, {_k('customer/', 'c_custkey')} AS uri FROM customer
        UNION ALL SELECT 'Organization', {_k('supplier/', 's_suppkey')} FROM supplier
        UNION ALL SELECT 'Product', {_k('part/', 'p_partkey')} FROM part""",
    "expand_lists": f"SELECT {_k('order/', 'l_orderkey')} AS uri, l_partkey, l_quantity FROM lineitem",
    "frame_nested": f"""
        SELECT {_k('order/', 'o.o_orderkey')} AS uri, o.o_totalprice, c.c_name, n.n_name, r.r_name
        FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
             LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
             LEFT JOIN region r ON r.r_regionkey = n.n_regionkey""",
    "frame_from_split": f"""
        SELECT {_k('order/', 'o.o_orderkey')} AS uri, o.o_totalprice, c.c_name, n.n_name, r.r_name
        FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
             LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
             LEFT JOIN region r ON r.r_regionkey = n.n_regionkey""",
    "frame_explicit": f"""
        SELECT {_k('order/', 'o.o_orderkey')} AS uri, o.o_totalprice, c.c_name,
               CAST(2 AS INTEGER) AS order_keys, CAST(1 AS INTEGER) AS customer_keys
        FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey""",
    "frame_multi": f"""
        SELECT {_k('order/', 'o.o_orderkey')} AS uri, c.c_name, {_k('part/', 'l.l_partkey')} AS part_uri, p.p_brand
        FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey
             LEFT JOIN customer c ON c.c_custkey = o.o_custkey
             LEFT JOIN part p ON p.p_partkey = l.l_partkey""",
    "frame_no_embed": f"SELECT {_k('order/', 'o_orderkey')} AS uri, {_k('customer/', 'o_custkey')} AS customer_ref FROM orders",
    "self_links": f"""
        SELECT {_k('customer/', 'c_custkey')} AS uri, {_k('customer/', 'c_custkey')} AS link_uri,
               {_k('customer/', 'c_custkey')} AS match_uri FROM customer""",
    "base_documents": f"""
        SELECT {_k('customer/', 'c_custkey')} AS uri, c_name AS name, {_k('customer/', 'c_custkey')} AS doc_uri FROM customer""",
    "base_documents_rejected": f"SELECT {_k('supplier/', 's_suppkey')} AS value FROM supplier",
    "fingerprint": f"""
        SELECT {_k('customer/', 'c_custkey')} AS uri, lower(hex({_k('customer/', 'c_custkey')})) AS uri_hex,
               upper(sha1('{{"a":"Customer","c_custkey":' || CAST(c_custkey AS VARCHAR) || ',"c_mktsegment":"' || c_mktsegment
                          || '","c_name":"' || c_name || '","c_nationkey":' || CAST(c_nationkey AS VARCHAR)
                          || ',"uri":"customer/' || CAST(c_custkey AS VARCHAR) || '"}}')) AS hash
        FROM customer""",
    "increment_new": f"SELECT {_k('event/', 'event_id')} AS uri, event_type FROM events WHERE event_type = 'signup'",
    "increment_changed": f"""
        SELECT {_k('event/', 'event_id')} AS uri, event_type FROM events WHERE event_type = 'error' AND value IS NOT NULL""",
    "increment_all": f"""
        SELECT {_k('event/', 'event_id')} AS uri, event_type,
               CASE WHEN event_type = 'signup' THEN 'new' ELSE 'changed' END AS status
        FROM events WHERE event_type = 'signup' OR (event_type = 'error' AND value IS NOT NULL)""",
    "increment_state": f"SELECT lower(hex({_k('event/', 'event_id')})) AS uri_hex, true AS up_to_date FROM events",
    "increment_rounds": f"""
        SELECT {_k('event/', 'event_id')} AS uri, event_type
        FROM events WHERE event_type = 'signup' OR (event_type = 'error' AND value IS NOT NULL)""",
    "one_per_uri": f"""
        SELECT uri, o_orderkey, o_orderstatus FROM (
            SELECT {_k('customer/', 'o_custkey')} AS uri, o_orderkey, o_orderstatus,
                   row_number() OVER (PARTITION BY o_custkey ORDER BY
                       sha1('{{"o_orderkey":' || CAST(o_orderkey AS VARCHAR) || ',"o_orderstatus":"' || o_orderstatus || '"}}') DESC) AS rn
            FROM orders) t WHERE rn = 1""",
    "text_round_trip": f"""
        SELECT {_k('customer/', 'c_custkey')} AS uri, c_name, c_acctbal, {_k('nation/', 'c_nationkey')} AS nation FROM customer""",
    "table_documents": "SELECT CAST(event_id AS VARCHAR) AS uri, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
}

_MERGED_CUSTOMER_SQL = f"""
        SELECT {_k('order/', 'o.o_orderkey')} AS uri, c.c_name, c.c_mktsegment, c.c_acctbal, CAST(NULL AS VARCHAR) AS role,
               CASE WHEN c.c_custkey IS NOT NULL THEN {_k('customer/', 'o.o_custkey')} END AS customer_uri
        FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey"""

ORACLES |= {
    "basic_merge_partitioned": _MERGED_CUSTOMER_SQL,
    "basic_merge_salted": _MERGED_CUSTOMER_SQL,
    "basic_merge_keyless": f"""
        SELECT CASE WHEN o.o_orderstatus <> 'P' THEN {_k('order/', 'o.o_orderkey')} END AS uri, {_k('order/', 'o.o_orderkey')} AS doc_uri,
               CASE WHEN o.o_orderstatus <> 'P' THEN c.c_name END AS c_name
        FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey""",
    "link_merge_absent_base": ORACLES["link_merge"],
    "link_resolve_multi": f"""
        SELECT {_k('supplier-nation/', 's.s_suppkey')} AS uri, n.n_name
        FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey OR n.n_nationkey = (s.s_nationkey + 1) % 25""",
    "dedup_top_level": f"""
        SELECT {_k('order/', 'l_orderkey')} AS uri, CAST(l_linenumber AS BIGINT) AS l_linenumber,
               CASE WHEN l_partkey = l_suppkey THEN 1 ELSE 2 END AS n_keys
        FROM lineitem""",
    "frame_checkpointed": ORACLES["frame_nested"],
    "frame_manifest": ORACLES["frame_nested"],
    "fingerprint_numbers": f"SELECT {_k('customer/', 'c_custkey')} AS uri, true AS same FROM customer WHERE c_acctbal IS NOT NULL",
    "increment_duplicate_keys": ORACLES["increment_all"],
    "increment_three_rounds": f"SELECT lower(hex({_k('event/', 'event_id')})) AS uri_hex, CAST(1 AS BIGINT) AS rows FROM events",
    "increment_overlapping": f"""
        SELECT {_k('event/', 'event_id')} AS uri, event_type, 'second' AS writer FROM events
        UNION ALL SELECT {_k('event/', 'event_id')}, event_type, 'first' FROM events WHERE event_type = 'error' AND value IS NOT NULL
        UNION ALL SELECT {_k('event/', 'event_id')}, NULL, 'state' FROM events""",
    "increment_many_rounds": f"""
        SELECT {_k('event/', 'event_id')} AS uri, CAST(event_id % 40 AS INTEGER) AS round FROM events
        UNION ALL SELECT {_k('event/', 'event_id')}, -1 FROM events""",
    "text_files": ORACLES["text_round_trip"],
    "sequence_files": ORACLES["text_round_trip"],
    "keyed_lines_rejected": f"""
        SELECT CASE c_nationkey WHEN 1 THEN {_k('customer/', 'c_custkey')} || chr(9) || '{{"cut'
                                WHEN 2 THEN '{{"c_custkey": ' || CAST(c_custkey AS VARCHAR) || '}}'
                                ELSE {_k('customer/', 'c_custkey')} END AS value,
               CASE c_nationkey WHEN 1 THEN 'malformed JSON' WHEN 2 THEN 'no key' ELSE '2' END AS reason
        FROM customer""",
    "stored_text_unescaped": ORACLES["table_documents"],
}
