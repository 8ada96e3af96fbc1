"""Text forms of the typer's records (SRC5, SRC9, SRC11-SRC14), as column expressions.

Used at the edges only (interchange with text tools); between steps the pipeline keeps
typed columns in Parquet. Decoding never throws: a malformed line gives NULL fields and
is filtered out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factweave import constants as C
from factweave.functions import computed_once
from factweave.session import cut_lineage, drop_stored


def esc(c, ch: str, token: str) -> F.Column:
    return F.replace(c, F.lit(ch), F.lit(token))


ENTITIES_PER_LINE = 100


def rel_info_line(entities: str = "es") -> F.Column:
    """SRC12 form of one row (rel, weight_2dp, array of entity texts): ``rel:weight(2dp):fbid,e1,e2:...``, ':' escaped as _COLON_."""
    pieces = F.concat(F.array(F.col("rel"), F.format_string("%.2f", "weight_2dp")), F.col(entities))
    return F.array_join(F.transform(pieces, lambda p: esc(p, ":", C.ESC_COLON)), ":")


def entity_texts(entities: DataFrame, type_dim: DataFrame, *by: str) -> DataFrame:
    """(by..., fbid, tkey, s): ``fbid,e1,e2`` of every entity, its types as numbers of the dictionary."""
    e = entities.select(*by, "fbid", "tkey", F.explode("types").alias("type")).join(type_dim.select("type", "enum"), "type", "inner")
    g = e.groupBy(*by, "fbid", "tkey").agg(F.array_sort(F.collect_list("enum")).alias("enums"))
    return g.select(*by, "fbid", "tkey", F.concat_ws(",", "fbid", F.array_join(F.transform("enums", lambda x: x.cast("string")), ",")).alias("s"))


def _line_rows(texts: DataFrame, *by: str) -> DataFrame:
    g = texts.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("fbid", "tkey", "s"))).alias("es"))
    return g.select(*by, F.transform("es", lambda x: x["s"]).alias("es"))


def encode_rel_info(rel_info: DataFrame, type_dim: DataFrame) -> DataFrame:
    """SRC12 write of RelInfo records (rel, weight_2dp, entities): one line per record."""
    ents = rel_info.select("rel", F.explode("entities").alias("e")).select("rel", "e.fbid", "e.tkey", "e.types")
    g = _line_rows(entity_texts(ents, type_dim, "rel"), "rel")
    r = rel_info.select("rel", "weight_2dp").join(g, "rel", "left").withColumn("es", F.coalesce("es", F.array().cast("array<string>")))
    return r.select("rel", rel_info_line().alias("line"))


def relation_lines(rel_info: DataFrame, rel_ent: DataFrame, type_dim: DataFrame) -> DataFrame:
    """SRC12 write of whole entity sets: a relation of n entities takes about n / ``ENTITIES_PER_LINE`` lines (rel, line).

    Lines are dealt by the entity's hash, so no row, task or line holds a large relation; ``decode_rel_info`` reads each on
    its own, and the lines of a relation together are its entity set.
    """
    no = F.pmod(F.conv(F.substring(F.md5(F.concat_ws("|", "fbid", "tkey")), 1, 8), 16, 10).cast("long"),
                F.ceil(F.col("n_entities") / ENTITIES_PER_LINE).cast("long"))
    dealt = rel_ent.join(rel_info.select("rel", "weight_2dp", "n_entities"), "rel").withColumn("line_no", no)
    # the numbers of a type set are looked up once, not for each entity that has it; stored, its size is known to the join
    sets = rel_ent.select("types").distinct()
    e = sets.select("types", F.explode("types").alias("type")).join(type_dim.select("type", "enum"), "type").groupBy("types").agg(F.array_sort(F.collect_list("enum")).alias("enums"))
    sets = cut_lineage(e.select("types", F.array_join(F.transform("enums", lambda x: x.cast("string")), ",").alias("enums")))
    by = ("rel", "weight_2dp", "line_no")
    texts = dealt.join(sets, "types").select(*by, "fbid", "tkey", F.concat_ws(",", "fbid", "enums").alias("s"))
    return _line_rows(texts, *by).select("rel", rel_info_line().alias("line"))


ENTITY_T = T.ArrayType(T.StructType([T.StructField("fbid", T.StringType()), T.StructField("enums", T.ArrayType(T.IntegerType()))]))


def decode_rel_info(lines: DataFrame, col: str = "line") -> DataFrame:
    """SRC12 read: rel, weight, entities(fbid, enums); a bad weight or enum drops the line."""
    p = computed_once(lines.select(col), p=F.transform(F.split(col, ":", -1), lambda x: esc(x, C.ESC_COLON, ":"))).filter(F.size("p") >= 2)
    texts = F.transform(F.slice("p", 3, F.greatest(F.size("p") - 2, F.lit(0))), lambda s: F.split(s, ",", -1))
    ents = F.transform(texts, lambda x: F.struct(x[0].alias("fbid"), F.transform(F.filter(F.slice(x, 2, F.size(x)), lambda t: t != ""),
                                                                                  lambda t: t.try_cast("int")).alias("enums")))
    out = computed_once(p.select("p"), rel=F.try_element_at("p", F.lit(1)), weight=F.try_element_at("p", F.lit(2)).try_cast("double"), entities=ents) \
        .select("rel", "weight", "entities")
    ok = F.col("weight").isNotNull() & F.forall("entities", lambda e: F.forall(e["enums"], lambda x: x.isNotNull()))
    return out.filter(ok)


def phase_one_lines(arg_rel: DataFrame, rel_lines: DataFrame) -> DataFrame:
    """SRC11: ``arg ⇥ relinfo`` with tabs inside either field escaped as _TAB_.

    The original repeats a relation's (sampled) entities with every argument. With whole entity sets a relation's
    lines are written once, without an argument; an argument's line names the relation and its weight alone.
    """
    name = F.concat(esc(F.col("rel"), ":", C.ESC_COLON), F.lit(":"), F.format_string("%.2f", "weight_2dp"))
    rows = rel_lines.select(F.lit("").alias("arg"), "line").unionByName(arg_rel.select("arg", name.alias("line")))
    return rows.select(F.concat_ws("\t", esc(F.col("arg"), "\t", C.ESC_TAB), esc(F.col("line"), "\t", C.ESC_TAB)).alias("value"))


def read_phase_one_lines(lines: DataFrame, type_dim: DataFrame, col: str = "value"):
    """SRC11 read: the lines of ``phase_one_lines`` as a phase one (without ``stats``). Bad lines are dropped; types unknown
    to the dictionary too.

    The lines are read once for the entities and once for the arguments: both, and the infos, are stored.
    """
    from factweave.operators.typing import PhaseOne, type_key
    p = computed_once(lines.select(col), p=F.transform(F.split(col, "\t", -1), lambda x: esc(x, C.ESC_TAB, "\t"))).filter(F.size("p") == 2) \
        .select(F.col("p")[0].alias("arg"), F.col("p")[1].alias("line"))
    ent = decode_rel_info(p.filter("arg = ''")).select("rel", "weight", F.explode("entities").alias("e"))
    # an entity is its line's text, so equal ones of several lines meet
    ent = cut_lineage(ent.select("rel", "weight", "e.fbid", "e.enums").distinct())
    key = ent.select("enums").distinct()
    known = cut_lineage(key.select("enums", F.explode("enums").alias("enum")).join(type_dim.select("enum", "type"), "enum")
                        .groupBy("enums").agg(F.array_sort(F.collect_set("type")).alias("types")))
    rel_ent = cut_lineage(ent.join(known, "enums").select("rel", "weight", "fbid", "types").withColumn("tkey", type_key("types")))
    drop_stored(ent)
    info = cut_lineage(rel_ent.groupBy("rel", F.col("weight").alias("weight_2dp")).agg(F.count(F.lit(1)).alias("n_entities")))
    a = p.filter("arg <> ''").select("arg", F.split("line", ":", -1).alias("r")).filter(F.size("r") == 2) \
        .select("arg", esc(F.col("r")[0], C.ESC_COLON, ":").alias("rel")).distinct()
    arg_rel = cut_lineage(a.join(info, "rel").select("arg", "rel", "weight_2dp", "n_entities"))
    return PhaseOne(None, info, rel_ent.select("rel", "fbid", "tkey", "types"), arg_rel)


def fmt_2dp(d) -> F.Column:
    """Half-up two decimals of a DECIMAL (exact, engine independent)."""
    return d.cast("decimal(38,2)").cast("string")


def encode_prediction(pred: DataFrame) -> DataFrame:
    """SRC13: arg ⇥ type@share, ... ⇥ rel:weight, ... ⇥ total(2dp) ⇥ fbid,fbid.

    '@' in type/share pieces -> _ATSYM_, ':' in relation pieces -> _COLON_, tabs in any
    field -> _TAB_.
    """
    types = F.array_join(F.transform("types", lambda t: F.concat(esc(t["type"], "@", C.ESC_AT), F.lit("@"),
                                                                  t["share"].cast("string"))), ", ")
    rels = F.array_join(F.transform("rels", lambda r: F.concat(esc(r["rel"], ":", C.ESC_COLON), F.lit(":"),
                                                                F.format_string("%.2f", r["weight"]))), ", ")
    fields = [F.col("arg"), types, rels, fmt_2dp(F.col("total_weight")), F.array_join("top_fbids", ",")]
    return pred.select("arg", F.concat_ws("\t", *[esc(f, "\t", C.ESC_TAB) for f in fields]).alias("value"))


def decode_prediction(lines: DataFrame, type_dim: DataFrame, col: str = "value") -> DataFrame:
    """SRC14: needs >= 5 tab fields; types unknown to the dictionary are dropped and a line
    without a known type is dropped; the total uses a plain double parse."""
    # equal lines are decoded once and repeated at the end, so a line is its own key
    lines = lines.groupBy(F.col(col).alias("_line")).agg(F.count(F.lit(1)).alias("_times"))
    p = lines.select("_line", "_times", F.transform(F.split("_line", "\t", -1), lambda x: esc(x, C.ESC_TAB, "\t")).alias("p")) \
        .filter(F.size("p") >= 5)
    p = p.select("_line", "_times", F.try_element_at("p", F.lit(1)).alias("arg"), F.try_element_at("p", F.lit(2)).alias("types_s"),
                 F.try_element_at("p", F.lit(3)).alias("rels_s"), F.try_element_at("p", F.lit(4)).try_cast("double").alias("total_weight"),
                 F.split(F.try_element_at("p", F.lit(5)), ",", -1).alias("top_fbids"))
    t = p.select("_line", F.posexplode(F.split("types_s", ", ", -1)).alias("i", "ts")) \
        .select("_line", "i", F.split("ts", "@", -1).alias("x")).filter(F.size("x") >= 2) \
        .select("_line", "i", esc(F.col("x")[0], C.ESC_AT, "@").alias("type"), F.col("x")[1].try_cast("int").alias("share"))
    t = t.join(type_dim.select("type", "enum"), "type", "inner").filter(F.col("share").isNotNull())
    t = t.groupBy("_line").agg(F.array_sort(F.collect_list(F.struct("i", "type", "enum", "share"))).alias("t"))
    out = p.join(t, "_line", "inner").withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))))
    rels = F.filter(F.transform(F.split("rels_s", ", ", -1), lambda r: F.split(r, ":", -1)), lambda x: F.size(x) >= 2)
    return out.select("arg", F.transform("t", lambda x: F.struct(x["type"].alias("type"), x["enum"].alias("enum"),
                                                                  x["share"].alias("share"))).alias("types"),
                      F.transform(rels, lambda x: F.struct(esc(x[0], C.ESC_COLON, ":").alias("rel"),
                                                           x[1].try_cast("double").alias("weight"))).alias("rels"),
                      "total_weight", "top_fbids")


def write_type_dim(type_dim: DataFrame) -> DataFrame:
    """SRC9 text form: enum ⇥ type ⇥ instances."""
    return type_dim.select(F.concat_ws("\t", F.col("enum").cast("string"), "type", F.col("instances").cast("string")).alias("value"))


def read_type_dim(lines: DataFrame, col: str = "value") -> DataFrame:
    """SRC9 read (the code's column order: enum, type, instances); bad lines dropped."""
    p = lines.select(F.split(col, "\t", -1).alias("p")).filter(F.size("p") >= 3)
    out = p.select(F.try_element_at("p", F.lit(1)).try_cast("int").alias("enum"), F.try_element_at("p", F.lit(2)).alias("type"),
                   F.try_element_at("p", F.lit(3)).try_cast("int").alias("instances"))
    return out.filter(F.col("enum").isNotNull() & F.col("instances").isNotNull())


def groups_to_json(groups: DataFrame) -> DataFrame:
    """SRC5 write: one JSON object per nested group."""
    return groups.select(F.to_json(F.struct(*groups.columns)).alias("value"))


def groups_from_json(lines: DataFrame, schema: T.StructType, col: str = "value") -> DataFrame:
    """SRC5 read: unparsable lines become NULL and are dropped."""
    g = computed_once(lines.select(col), _g=F.from_json(col, schema))  # parsed once, not for the filter and for each field
    return g.filter(F.col("_g").isNotNull()).select("_g.*")
