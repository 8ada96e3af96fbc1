"""Text record formats at the edges (SRC3, SRC4, SRC6-SRC8).

Inside the pipeline data stays in typed columns; these readers and writers convert tab
lines with plain column expressions (``split`` with a literal tab, ``try_cast``), so a bad
line becomes NULL fields and is filtered out instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factweave.functions import computed_once

# FIXED VALUES: field order of the 26-column extraction-sentence record.
RECORD_FIELDS = [
    "docname", "extractorType", "sentenceid", "eid", "url", "hashes", "confidence",
    "arg1", "rel", "arg2",
    "norm1Arg1", "norm1Rel", "norm1Arg2", "norm2Arg1", "norm2Rel", "norm2Arg2",
    "norm1Arg1PosTags", "norm1RelPosTags", "norm1Arg2PosTags",
    "norm2Arg1PosTags", "norm2RelPosTags", "norm2Arg2PosTags",
    "arg1Tag", "relTag", "arg2Tag", "dataString",
]
INT_FIELDS = {"sentenceid", "eid"}
DOUBLE_FIELDS = {"confidence"}
TAB = "\t"


def tab_split(col: str = "value") -> F.Column:
    """Split on a literal tab, keeping trailing empty fields."""
    return F.split(F.col(col), TAB, -1)


def read_raw_sentences(lines: DataFrame, col: str = "value") -> DataFrame:
    """SRC3: ``sentence ⇥ url [⇥ ignored...]``; fewer than two fields -> dropped."""
    p = lines.select(tab_split(col).alias("p"))
    return p.filter(F.size("p") >= 2).select(F.try_element_at("p", F.lit(1)).alias("sentence"), F.try_element_at("p", F.lit(2)).alias("url"))


def write_layered(df: DataFrame) -> DataFrame:
    """``tokens ⇥ postags ⇥ chunks ⇥ url`` with space-joined layers."""
    return df.select(F.concat_ws(TAB, F.array_join("tokens", " "), F.array_join("postags", " "),
                                 F.array_join("chunks", " "), F.col("url")).alias("value"))


def read_layered(lines: DataFrame, col: str = "value") -> DataFrame:
    """SRC4: at least 4 tab fields; layers split on one whitespace character; the three
    layers must have equal lengths, else the line yields nothing."""
    p = computed_once(lines.select(F.col(col).alias("_value")), p=tab_split("_value")).filter(F.size("p") >= 4)
    ws = r"\s"
    layers = {k: F.split(F.try_element_at("p", F.lit(i)), ws) for i, k in enumerate(("tokens", "postags", "chunks"), 1)}
    x = computed_once(p, **layers, url=F.try_element_at("p", F.lit(4))).select(*layers, "url")
    return x.filter((F.size("tokens") == F.size("postags")) & (F.size("postags") == F.size("chunks")))


def write_records(df: DataFrame) -> DataFrame:
    """SRC8: the 26 fields joined by tabs, in order (``dataString`` may itself hold tabs)."""
    return df.select(F.concat_ws(TAB, *[F.col(c).cast("string") for c in RECORD_FIELDS]).alias("value"))


NO_FIELDS, NO_NUMBER = "too few fields", "not a number"


def parse_records(lines: DataFrame, col: str = "value") -> DataFrame:
    """SRC6, two-sided: every line (with the columns of ``lines``) with its 26 fields, or with the ``reason`` why not.

    Positions 0-24 are scalar fields, everything from 25 on is re-joined by tabs into ``dataString``.
    """
    p = computed_once(lines, _p=tab_split(col))
    cols = {}
    for i, name in enumerate(RECORD_FIELDS[:-1]):
        c = F.try_element_at("_p", F.lit(i + 1))
        if name in INT_FIELDS:
            c = c.try_cast("int")
        elif name in DOUBLE_FIELDS:
            c = c.try_cast("double")
        cols[name] = c
    cols["dataString"] = F.array_join(F.slice("_p", len(RECORD_FIELDS), F.greatest(F.size("_p"), F.lit(0))), TAB)
    out = computed_once(p, **cols, _n=F.size("_p")).drop("_p")
    reason = F.when(F.coalesce("_n", F.lit(0)) < len(RECORD_FIELDS), NO_FIELDS) \
        .when(F.col("sentenceid").isNull() | F.col("eid").isNull() | F.col("confidence").isNull(), NO_NUMBER)
    return out.withColumn("reason", reason).drop("_n")


def read_records(lines: DataFrame, col: str = "value") -> DataFrame:
    """SRC6: the records of ``lines``. Lines with fewer than 26 fields or unparsable numbers are dropped."""
    return parse_records(lines.select(F.col(col).alias("_value")), "_value").filter(F.col("reason").isNull()).select(*RECORD_FIELDS)


def record_derived(rec: DataFrame) -> DataFrame:
    """SRC7: norm1String, norm2String, tagString; sentence = part 0 of dataString, POS tags =
    part 2 and chunk tags = part 3 (trimmed, split on a space)."""
    d = F.split(F.col("dataString"), TAB, -1)
    return rec.select(
        "docname", "sentenceid", "eid",
        F.concat_ws(TAB, "norm1Arg1", "norm1Rel", "norm1Arg2").alias("norm1String"),
        F.concat_ws(TAB, "norm2Arg1", "norm2Rel", "norm2Arg2").alias("norm2String"),
        F.concat_ws(TAB, "arg1Tag", "relTag", "arg2Tag").alias("tagString"),
        d[0].alias("sentence"),
        F.split(F.trim(F.try_element_at(d, F.lit(3))), " ").alias("posTags"),
        F.split(F.trim(F.try_element_at(d, F.lit(4))), " ").alias("chunkTags"))
