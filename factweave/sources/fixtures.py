"""Views that map the driver's tables onto the pipeline's schemas.

Every view is derived by Spark from the given tables, so its size grows with them:

* ``extractions`` - one extraction per lineitem: the sentence
  "<p_name> <p_brand> is supplied by <n_name> <s_name>" with token spans for arg1
  (part), relation and arg2 (supplier); the url names the order line. Links carried by the
  fixture: arg1 -> part entity ``m.<partkey>`` unless partkey % 5 = 0, arg2 -> supplier
  entity ``s.<suppkey>`` unless suppkey % 3 = 0.
* ``tuples`` - the flat typing view (arg1, arg1_fbid, arg1_types, rel, arg2, ...), one row
  per extraction (duplicates kept), with ``row_id`` (order key | line number) as evidence.
* ``type_dim`` - the type dictionary (enum, type, instances).

The relation names the supplier's nation (25 relations), so a relation holds 1/25 of all
rows: the per-relation caps (150 sampled entities, 1 000 arguments) really bind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factweave.functions import normalize_arg_tokens, normalize_rel_tokens, span_tokens
from factweave.session import table_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def part_types() -> F.Column:
    """Types of a part entity (this fixture's rule), unsorted."""
    brand_no = F.substring_index(F.col("p_brand"), "#", -1).cast("int")
    size_t = F.concat(F.lit("/size/s"), (F.col("p_size") % 10).cast("string"))
    brand_t = F.concat(F.lit("/brand/b"), (brand_no % 7).cast("string"))
    pk = F.col("p_partkey")
    base = F.when(pk % 3 == 0, F.array(size_t, brand_t, F.lit("/base/catalog"))).otherwise(F.array(size_t, brand_t))
    base = F.when(pk % 17 == 0, F.array_union(base, F.array(F.lit("/misc/unknown")))).otherwise(base)
    return F.array_sort(F.when(pk % 13 == 0, F.array(F.lit("/base/catalog"), F.lit("/tv/tv_subject"))).otherwise(base))


def supplier_types() -> F.Column:
    return F.array_sort(F.array(F.lit("/business/supplier"),
                                F.concat(F.lit("/location/n"), F.col("s_nationkey").cast("string"))))


def extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    p = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    sn = s.join(n, s.s_nationkey == n.n_nationkey)
    df = li.join(p, li.l_partkey == p.p_partkey).join(sn, li.l_suppkey == sn.s_suppkey)
    a1 = F.split(F.concat_ws(" ", "p_name", "p_brand"), " ")
    rl = F.split(F.concat(F.lit("is supplied by "), F.col("n_name")), " ")
    a2 = F.split(F.col("s_name"), " ")
    df = df.select(
        "l_orderkey", "l_linenumber",
        F.concat(a1, rl, a2).alias("tokens"),
        F.lit(0).alias("arg1_start"), F.size(a1).alias("arg1_len"),
        F.size(a1).alias("rel_start"), F.size(rl).alias("rel_len"),
        (F.size(a1) + F.size(rl)).alias("arg2_start"), F.size(a2).alias("arg2_len"),
        F.concat(F.lit("http://orders.example/"), F.col("l_orderkey").cast("string"), F.lit("#"),
                 F.col("l_linenumber").cast("string")).alias("url"),
        F.lit("lineitem").alias("corpus"),
        F.when(F.col("p_partkey") % 5 != 0, F.concat(F.lit("m."), F.col("p_partkey").cast("string"))).alias("arg1_fbid"),
        F.concat_ws(" ", "p_name", "p_brand").alias("arg1_name"),
        (F.col("p_partkey") % 7).alias("arg1_inlinks"),
        part_types().alias("arg1_etypes"),
        F.when(F.col("s_suppkey") % 3 != 0, F.concat(F.lit("s."), F.col("s_suppkey").cast("string"))).alias("arg2_fbid"),
        F.col("s_name").alias("arg2_name"),
        (F.col("s_suppkey") % 4).alias("arg2_inlinks"),
        supplier_types().alias("arg2_etypes"),
    )
    return df.withColumn("arg1_types", F.when(F.col("arg1_fbid").isNotNull(), F.col("arg1_etypes"))
                         .otherwise(F.array().cast("array<string>"))) \
             .withColumn("arg2_types", F.when(F.col("arg2_fbid").isNotNull(), F.col("arg2_etypes"))
                         .otherwise(F.array().cast("array<string>"))) \
             .drop("arg1_etypes", "arg2_etypes")


def with_norms(ex: DataFrame) -> DataFrame:
    """Add the grouping key (arg1, rel, arg2) computed by the key normaliser (TX4)."""
    keep = [c for c in ex.columns if c not in ("arg1", "rel", "arg2")]
    return ex.select(*keep,
                     normalize_arg_tokens(span_tokens("tokens", "arg1_start", "arg1_len")).alias("arg1"),
                     normalize_rel_tokens(span_tokens("tokens", "rel_start", "rel_len")).alias("rel"),
                     normalize_arg_tokens(span_tokens("tokens", "arg2_start", "arg2_len")).alias("arg2"))


def tuples(spark: SparkSession, sf_dir: str) -> DataFrame:
    ex = with_norms(extractions(spark, sf_dir))
    return ex.select("arg1", "arg1_fbid", "arg1_types", "rel", "arg2", "arg2_fbid", "arg2_types",
                     F.concat_ws("|", F.col("l_orderkey").cast("string"),
                                 F.col("l_linenumber").cast("string")).alias("row_id"))


def type_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type dictionary (enum, type, instances) derived from the part and supplier tables.

    enum 0-9 '/size/s<n>', 100-106 '/brand/b<n>', 200 '/base/catalog', 201 '/tv/tv_subject',
    300 '/business/supplier', 400+k '/location/n<k>'; '/misc/unknown' is deliberately absent.
    instances = number of parts (or suppliers) carrying the type.
    """
    p = read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    pt = p.select(F.explode(part_types()).alias("type"))
    s = read(spark, sf_dir, "supplier").select("s_nationkey")
    st = s.select(F.explode(supplier_types()).alias("type"))
    t = pt.unionByName(st).filter(F.col("type") != "/misc/unknown").groupBy("type") \
        .agg(F.count(F.lit(1)).cast("int").alias("instances"))
    num = F.substring_index(F.col("type"), "/", -1)
    enum = (F.when(F.col("type").startswith("/size/s"), F.regexp_extract(num, "[0-9]+", 0).cast("int"))
            .when(F.col("type").startswith("/brand/b"), F.lit(100) + F.regexp_extract(num, "[0-9]+", 0).cast("int"))
            .when(F.col("type") == "/base/catalog", F.lit(200))
            .when(F.col("type") == "/tv/tv_subject", F.lit(201))
            .when(F.col("type") == "/business/supplier", F.lit(300))
            .otherwise(F.lit(400) + F.regexp_extract(num, "[0-9]+", 0).cast("int")))
    return t.select(enum.alias("enum"), "type", "instances")


def link_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Linking tables for the fixture: (anchors, entities).

    anchors(anchor, fbid, link_count): lower-case part names -> part entities and supplier
    names -> supplier entities; link_count = lineitems of the entity. entities(fbid, name,
    inlinks, types, context): context = the part's brand / the supplier's nation, which the
    source sentences mention, so context decides between parts sharing a name.

    The knowledge base has gaps: parts whose key divides by 19 have anchors but no entity, and
    the context of parts with keys divisible by 23 and suppliers with keys divisible by 7 is NULL.
    """
    li = read(spark, sf_dir, "lineitem")
    pc = li.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    sc = li.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    p = read(spark, sf_dir, "part").join(pc, F.col("p_partkey") == F.col("l_partkey"), "left")
    s = read(spark, sf_dir, "supplier").join(read(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")) \
        .join(sc, F.col("s_suppkey") == F.col("l_suppkey"), "left")
    pf = F.concat(F.lit("m."), F.col("p_partkey").cast("string"))
    sf = F.concat(F.lit("s."), F.col("s_suppkey").cast("string"))
    anchors = p.select(F.lower("p_name").alias("anchor"), pf.alias("fbid"), F.coalesce("n", F.lit(0)).alias("link_count")) \
        .unionByName(s.select(F.lower("s_name").alias("anchor"), sf.alias("fbid"), F.coalesce("n", F.lit(0)).alias("link_count")))
    ents = p.filter(F.col("p_partkey") % 19 != 0).select(pf.alias("fbid"), F.concat_ws(" ", "p_name", "p_brand").alias("name"),
                    F.coalesce("n", F.lit(0)).alias("inlinks"), part_types().alias("types"),
                    F.when(F.col("p_partkey") % 23 != 0, F.array(F.lower("p_brand"))).alias("context")) \
        .unionByName(s.select(sf.alias("fbid"), F.col("s_name").alias("name"), F.coalesce("n", F.lit(0)).alias("inlinks"),
                              supplier_types().alias("types"), F.when(F.col("s_suppkey") % 7 != 0, F.array(F.lower("n_name"))).alias("context")))
    return anchors, ents
