"""Readers and annotators form each array once, and the look-ups by hash sets give what the chains of comparisons gave."""

import contextlib
import io

from pyspark.sql import functions as F

from factweave import constants as C
from factweave.operators import text as TX
from factweave.sources import records as RC

ODD = ["the", "not", "on", "ring", "rings", "ed", "walked", "42", "4x", "٤٢", "ly", "only", "4ly", "#", "…", "é", "Ünly", "", "thé", "ſ", "will", "ing", "12\n", "-ly", None]


def optimized(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(True)
    return out.getvalue().split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]


def docs(spark):
    rows = [(1, "The ring is supplied by Peru. It was on the 3 old boxes!\nNo verb", "a"), (2, None, "a"), (5, "", None), (10, "Rings were made by men\n\nx", "b")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_layered_lines_are_annotated_once(spark):
    a = TX.annotate(TX.sentences(docs(spark), url_col=None)).withColumn("url", F.col("doc_id").cast("string"))
    r = RC.read_layered(RC.write_layered(a))
    plan = optimized(r)
    assert plan.count("regexp_extract_all(") == 1 and plan.count("[.!?]") == 1
    assert sorted((x.url, x.tokens, x.postags) for x in r.collect())[0] == ("1", ["it", "was", "on", "the", "3", "old", "boxes"], ["PRP", "VBD", "IN", "DT", "CD", "NN", "NNS"])


def test_records_are_read_once(spark):
    ex = TX.document_extractions(docs(spark))
    cols = {c: F.lit(1) if c in RC.INT_FIELDS else F.lit(0.5) if c in RC.DOUBLE_FIELDS else F.array_join("tokens", " ") for c in RC.RECORD_FIELDS}
    r = RC.read_records(RC.write_records(ex.select(*[v.alias(k) for k, v in cols.items()])))
    assert optimized(r).count("regexp_extract_all(lower(") == 1
    assert sorted(x.arg1 for x in r.collect()) == ["rings were made by men", "the ring is supplied by peru"]


def test_tags_equal_the_chain_of_comparisons(spark):
    t = F.col("t")
    penn, cls = F, F
    for w, tag in C.LEXICON.items():
        penn = penn.when(t == w, F.lit(tag))
    penn = penn.when(~t.rlike(TX.WORD_RE), "SYM").when(t.rlike("^[0-9]+$"), "CD").when(t.endswith("ly"), "RB").when(t.endswith("ing"), "VBG") \
        .when(t.endswith("ed"), "VBD").when(t.endswith("s"), "NNS").otherwise("NN")
    for k in ("D", "P", "C", "V", "R"):
        cls = cls.when(t.isin(*TX.CLASS_WORDS[k]), F.lit(k))
    cls = cls.when(~t.rlike(TX.WORD_RE), "O").when(t.endswith("ly"), "R").otherwise("N")
    df = spark.createDataFrame([(w,) for w in [*ODD, *C.LEXICON]], "t string")
    for r in df.select("t", penn.alias("p"), cls.alias("c"), TX.penn_tag(t).alias("p2"), TX.token_class(t).alias("c2")).collect():
        assert (r.p, r.c) == (r.p2, r.c2), r.t


def test_lines_are_parsed_once_and_skipped_ones_counted(spark, tmp_path, monkeypatch):
    from factweave.plans import registry as R
    calls = []
    good = "http://a\t[NP small/JJ ring/NN ] [VP is/VBZ ] [NP blue/JJ ]\t[0, 2]\t[2, 3]\t[3, 4]\t/1"
    bad = good.replace("[3, 4]", "[3, 9]")

    def lines(s, d):
        seen = s.sparkContext.accumulator(0)
        calls.append(seen)
        rows = s.sparkContext.parallelize([good, good, bad, "x"], 2)
        return rows.map(lambda v: (seen.add(1), v)[1:]).toDF("value string")
    monkeypatch.setattr(R, "old_layout_lines", lines)
    got = sorted(tuple(r) for r in R.inc6_line_ingest(spark, "").select("rel", "n").collect())
    assert got == [("", 1), ("skipped lines", 2)]
    assert calls[0].value == 4


WORDS = ["rings", "Ring", "men", "women", "Mens", "a b s", "s", "is", "was", "very", "cities", "dish\n", "rings\n", "feet", "ΟΔΟΣ", "'Β", "ΣΑΣ", "İs", "", "boxes", "ment", "supplied", "BY", "́Σ", "x ", None]


def test_keys_equal_the_token_by_token_form(spark):
    from factweave.functions import normalize_arg_tokens, normalize_rel_tokens, stem_tokens
    rows = [([a, b, c],) for a in WORDS for b in ("blue", "is", None, "ties") for c in WORDS] + [([],), (None,)]
    df = spark.createDataFrame(rows, "t array<string>")
    low = F.transform("t", lambda t: F.lower(t))
    arg = F.array_join(stem_tokens(low), " ")
    rel = F.array_join(stem_tokens(F.filter(low, lambda t: ~t.isin(*C.REL_DROP_WORDS))), " ")
    bad = df.filter(~normalize_arg_tokens("t").eqNullSafe(arg) | ~normalize_rel_tokens("t").eqNullSafe(rel))
    assert bad.count() == 0


def test_identities_are_equal_where_the_hashes_are(spark):
    from factweave.operators import grouping as G
    toks = [None, [], [""], ["a"], ["a", "b"], ["ab"], ["a", None], [None, "a"], ["a\x01b"], ["a\x01", "b"], ["\x02", None], [None, "\x02"], ["\x02", "\x02"],
            [None, None], ["1:a,1:b"], ["", ""], ["p1:a"], ["j"], ["a", "", "b"]]
    others = [("u", "c", 1, 0.5), (None, "c", 1, 0.5), ("~", "c", None, 0.5), ("u", None, 1, None), ("u|1:c", "", 1, 0.5000001), ("u", "1:c|", 11, 0.5)]
    rows = [(t, s, 2, 3, 4, 5, n, u, c, f) for t in toks for u, c, s, f in others for n in (6, None)]
    df = spark.createDataFrame(rows * 2, "tokens array<string>, " + ", ".join(f"{s} int" for s in G.SPANS) + ", url string, corpus string, confidence double")
    got = df.select(G.instance_hash().alias("h"), G.instance_identity().alias("i")).distinct().collect()
    assert len({r.h for r in got}) == len({bytes(r.i) for r in got}) == len(got)
    assert optimized(df.select(G.instance_identity().alias("i"))).count("transform(") == 1


def test_phrases_without_endings_meet_no_token_rules(spark):
    """The counting of instances and the keys look at single tokens only on the long way (a branch), as the plan shows."""
    from factweave.functions import normalize_arg_tokens
    plan = optimized(spark.createDataFrame([(["blue", "ring"],)], "t array<string>").select(normalize_arg_tokens("t").alias("k")))
    assert plan.index("CASE WHEN") < plan.index("transform(")


def ex_rows(spark, rows):
    from factweave.operators import grouping as G
    schema = ", ".join(f"{k} string" for k in G.KEY) + ", tokens array<string>, " + ", ".join(f"{s} int" for s in G.SPANS) + ", url string, corpus string, confidence double"
    full = [(*k, ["blue", "ring", "by", "peru"], 0, 2, 2, 1, 3, 1, u, "c", 0.5) for k, u in rows]
    return spark.createDataFrame(full, schema)


def test_capped_rows_are_formed_once(spark):
    from factweave.operators import grouping as G
    rows = [(("a", "r", "b"), f"u{i % 5}") for i in range(9)] + [((None, "r", "b"), "u")] * 4 + [(("c", "r", None), "v")]
    df = ex_rows(spark, rows)
    got = G.group_instances(df, max_group_size=2, columns=[])
    assert got.columns == [*G.KEY, "inst_id"] and "md5(" not in optimized(got)
    every = [(r.arg1, r.inst_id) for r in df.withColumn("inst_id", G.instance_hash()).collect()]
    want = {(k, h) for k in ("a", None, "c") for h in sorted(h for a, h in every if a == k)[:2]}
    assert {(r.arg1, r.inst_id) for r in got.collect()} == want and got.count() == len(want)
    wide = G.group_instances(df, max_group_size=2)
    assert {(r.arg1, r.inst_id, r.url) for r in wide.collect()} == {(r.arg1, r.inst_id, r.url) for r in G.group_instances(df).collect() if (r.arg1, r.inst_id) in want}


def test_rendered_groups_form_their_rows_once(spark):
    from factweave.plans import registry as R
    plan = optimized(R.pf10_render_groups(spark, "/root/testdata/sf0.001"))
    assert "md5(" not in plan and "l_partkey" not in plan


def test_inlink_ratio_ships_what_it_reads(spark):
    from factweave.plans import registry as R
    plan = optimized(R.pf1_inlink_ratio_arg2(spark, "/root/testdata/sf0.001"))
    assert "arg1_types" not in plan and "arg1_name" not in plan


def test_group_json_is_parsed_once(spark):
    from factweave.operators import grouping as G
    from factweave.sources import codecs as CD
    nested = G.nest_groups(G.group_instances(ex_rows(spark, [(("a", "r", "b"), "u"), (("a", "r", "b"), "v")])))
    back = CD.groups_from_json(CD.groups_to_json(nested), nested.schema)
    plan = optimized(back.select("arg1.norm", F.size("instances").alias("n")))
    assert plan.count("from_json(") == 1
    assert back.collect() == nested.collect()
