"""Text extraction and text-format round trips."""

import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from factweave.operators import text as TX
from factweave.sources import codecs as CD
from factweave.sources import old_layout as OL


def test_extraction_spans(spark):
    s = spark.createDataFrame([(1, "u", "The cat is on the mat. Birds are singing loudly")], "doc_id long, url string, sentence string")
    s = TX.sentences(s.withColumnRenamed("sentence", "text"), text_col="text", id_cols=("doc_id",), url_col="url")
    ex = TX.extract(s).select("arg1_start", "arg1_len", "rel_start", "rel_len", "arg2_start", "arg2_len").collect()
    # "the cat | is on | the mat" and "birds | are | singing" (classes D N V P D N and N V N R)
    assert sorted(tuple(r) for r in ex) == [(0, 1, 1, 1, 2, 1), (0, 2, 2, 2, 4, 2)]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="NDVPCR", min_size=0, max_size=60), min_size=1, max_size=8))
def test_anchored_pattern_matches_plain_pattern(spark, tags):
    """The \\G-anchored pattern (linear time) finds the same matches as the plain one."""
    df = spark.createDataFrame([(t,) for t in tags], "tags string")
    got = [tuple(r) for r in df.select(*[F.regexp_extract_all("tags", F.lit(TX.TRIPLE_RE_SPARK), i) for i in range(1, 5)]).collect()]
    want = []
    for t in tags:
        m = re.findall(TX.TRIPLE_RE_PLAIN, t)
        want.append(tuple([x[i] for x in m] for i in range(4)))
    assert got == want


def test_bracket_round_trip(spark):
    df = spark.createDataFrame([(["the", "cat", "is", "on", "mats", "and"], ["DT", "NN", "VBZ", "IN", "NNS", "CC"],
                                 ["B-NP", "I-NP", "B-VP", "B-PP", "B-NP", "O"])],
                               "tokens array<string>, postags array<string>, chunks array<string>")
    b = df.select(OL.to_bracketed().alias("b"))
    assert b.first().b == "[NP the/DT cat/NN ] [VP is/VBZ ] [PP on/IN ] [NP mats/NNS ] and/CC"
    back = b.select(OL.parse_bracketed("b").alias("t")).first().t
    assert [(x.string, x.postag, x.chunk) for x in back] == list(zip(*[df.first()[c] for c in ("tokens", "postags", "chunks")]))


def test_relinfo_round_trip(spark):
    info = spark.createDataFrame([("born:in", 0.23, [("m.1", ["/a/b", "/c/d"], "/a/b,/c/d"), ("m:2", ["/c/d"], "/c/d")])],
                                 "rel string, weight_2dp double, entities array<struct<fbid:string,types:array<string>,tkey:string>>")
    dim = spark.createDataFrame([(1, "/a/b", 5), (2, "/c/d", 5)], "enum int, type string, instances int")
    line = CD.encode_rel_info(info, dim)
    assert line.first().line == "born_COLON_in:0.23:m.1,1,2:m_COLON_2,2"
    back = CD.decode_rel_info(line).first()
    assert back.rel == "born:in" and back.weight == 0.23
    assert sorted((e.fbid, tuple(e.enums)) for e in back.entities) == [("m.1", (1, 2)), ("m:2", (2,))]


def test_prediction_round_trip(spark):
    pred = spark.createDataFrame([("an\targ", [("/x@y", 7, 3), ("/c/d", 2, 2)], [("r:1", 0.5)], 12.345, ["m.1", "m.2"])],
                                 "arg string, types array<struct<type:string,enum:int,share:long>>, "
                                 "rels array<struct<rel:string,weight:double>>, total_weight double, top_fbids array<string>")
    pred = pred.withColumn("total_weight", F.col("total_weight").cast("decimal(20,6)"))
    line = CD.encode_prediction(pred).first().value
    assert line == "an_TAB_arg\t/x_ATSYM_y@3, /c/d@2\tr_COLON_1:0.50\t12.35\tm.1,m.2"
    dim = spark.createDataFrame([(7, "/x@y", 1)], "enum int, type string, instances int")  # /c/d unknown -> dropped
    back = CD.decode_prediction(spark.createDataFrame([(line,)], "value string"), dim).first()
    assert back.arg == "an\targ" and [(t.type, t.share) for t in back.types] == [("/x@y", 3)]
    assert back.total_weight == 12.35 and [(r.rel, r.weight) for r in back.rels] == [("r:1", 0.5)]
