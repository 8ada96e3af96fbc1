"""Operator semantics and quirk regressions on small hand-made fixtures."""

from pyspark.sql import functions as F

from factweave.operators import attach as AT
from factweave.operators import grouping as G
from factweave.operators import typing as T
from factweave.functions import arg_string_ok, filter_types, weight_2dp


def test_arg_filter(spark):
    df = spark.createDataFrame([(a,) for a in ["abc", "abcd", "abc123", "abc12", "some", "three", "three cats"]], "a string")
    kept = {r.a for r in df.filter(arg_string_ok("a")).collect()}
    assert kept == {"abcd", "abc12", "three cats"}


def test_type_filter_and_blacklist(spark):
    df = spark.createDataFrame([(["/base/x", "/tv/tv_subject", "/people/person"],)], "t array<string>")
    assert df.select(filter_types("t").alias("f")).first().f == ["/people/person"]


def test_weight_rounding_half_up(spark):
    # 29/200 = 0.145 -> 0.15 (half-up), computed on integers
    df = spark.createDataFrame([(29, 200), (0, 1), (1, 1)], "s long, p long")
    assert [r.w for r in df.select(weight_2dp("s", "p").alias("w")).collect()] == [0.15, 0.0, 1.0]


def test_relation_weight_single_member_is_zero(spark):
    s = spark.createDataFrame([("rel a", "m.1", ["/a"], "/a")], "rel string, fbid string, types array<string>, tkey string")
    st = T.relation_stats(s).first()
    assert st.weight == 0.0 and st.n_sample == 1


def test_attach_only_untyped_and_only_its_role(spark):
    tup = spark.createDataFrame([
        ("long arg", ["/people/person"], "xx", []),       # typed: unchanged
        ("long arg", ["/tv/tv_subject"], "xx", []),       # only blacklisted: counts as untyped (Q9)
        ("abc", [], "xx", []),                            # a short key matches like any other (JN3)
    ], "arg1 string, arg1_types array<string>, arg2 string, arg2_types array<string>")
    pred = spark.createDataFrame([("long arg", [("/loc/city", 1, 5)]), ("abc", [("/loc/city", 1, 5)])],
                                 "arg string, types array<struct<type:string,enum:int,share:long>>")
    out = AT.attach_types(tup, pred, "arg1").collect()
    got = sorted((r.arg1, tuple(r.arg1_types)) for r in out)
    assert got == [("abc", ("/loc/city",)), ("long arg", ("/loc/city",)), ("long arg", ("/people/person",))]
    # Q2: attaching for arg2 never touches arg1
    tup2 = tup.withColumn("arg2", F.lit("long arg"))
    out2 = AT.attach_types(tup2, pred, "arg2").collect()
    assert sorted(tuple(r.arg1_types) for r in out2) == sorted(tuple(r.arg1_types) for r in tup2.collect())


def test_relink_rule(spark):
    df = spark.createDataFrame([(n,) for n in (1, 2, 4, 5, 6, 7)], "n long")
    got = [r.f for r in df.select(G.relink_flag("n").alias("f")).collect()]
    assert got == [False, True, True, False, True, False]


def test_frequency_filter_inclusive(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "n_instances long")
    assert df.transform(lambda d: G.frequency_filter(d, 2, 3)).count() == 2


def test_weights_between_zero_and_one(spark):
    from tests.conftest import SF_SMALL
    from factweave.plans import registry as R
    tup, dim = R.typing_inputs(spark, SF_SMALL)
    st = T.relation_stats(T.relation_sample(T.entity_occurrences(tup, R.TYPING, dim), R.TYPING))
    r = st.agg(F.min("weight"), F.max("weight"), F.max("n_sample")).first()
    assert 0.0 <= r[0] <= r[1] <= 1.0 and r[2] <= R.TYPING.max_entities_write_per_rel


def test_regroup_is_idempotent(spark):
    from tests.conftest import SF_SMALL
    from factweave.plans import registry as R
    inst, parts = R.batched(spark, SF_SMALL)
    m1, h1 = G.regroup(inst, parts)
    again_inst = m1.withColumn("gid", F.concat_ws("|", *G.KEY)).withColumn("batch", F.lit(0))
    again_parts = h1.drop("first_batch", "last_batch").withColumn("gid", F.concat_ws("|", *G.KEY)).withColumn("batch", F.lit(0))
    m2, h2 = G.regroup(again_inst, again_parts)
    key = lambda df: sorted(map(tuple, df.select(*G.KEY, "inst_id").collect()))
    assert key(m1) == key(m2)
    hk = lambda df: sorted(map(tuple, df.select(*G.KEY, "arg1_fbid", "arg2_fbid").collect()))
    assert hk(h1) == hk(h2)


def parts_row(gid, batch, key, fbid):
    return (gid, batch, *key, fbid, fbid, 1 if fbid else None, [], None, None, None, [])


PARTS = "gid string, batch int, arg1 string, rel string, arg2 string, " + ", ".join(
    f"{r}_fbid string, {r}_name string, {r}_inlinks long, {r}_types array<string>" for r in ("arg1", "arg2"))


def test_merge_head_is_the_first_linked_group_at_any_batch_number(spark):
    tokens = ["Cat", "likes", "Milk"]
    key = ("cat", "likes", "milk")
    batches = [(11, None), (9, "m.77"), (25, None), (30, "m.5")]
    inst = spark.createDataFrame([(f"g{b}", b, tokens, 0, 1, 1, 1, 2, 1, f"u{b}", "c", 0.5) for b, _ in batches],
                                 "gid string, batch int, tokens array<string>, arg1_start int, arg1_len int, rel_start int, rel_len int, "
                                 "arg2_start int, arg2_len int, url string, corpus string, confidence double")
    parts = spark.createDataFrame([parts_row(f"g{b}", b, key, f) for b, f in batches], PARTS)
    merged, head = G.regroup(inst, parts)
    assert merged.count() == 4 and [r.arg1_fbid for r in head.collect()] == ["m.77"]
    # two groups of one batch and key: the smaller gid comes first
    twins = spark.createDataFrame([parts_row("g9", 9, key, "m.9"), parts_row("g11", 9, key, "m.11")], PARTS)
    _, head = G.regroup(inst.filter("batch IN (9, 11)").withColumn("batch", F.lit(9)), twins)
    assert [r.arg1_fbid for r in head.collect()] == ["m.11"]


def test_instances_with_equal_joined_text_stay_apart(spark):
    rows = [(["a b", "c"], "u", "x"), (["a", "b c"], "u", "x"), (["a", "b c"], None, "u|x"), (["a", "b c"], "u|x", None), ([None, "c"], "u", "x"), (["~", "c"], "u", "x")]
    df = spark.createDataFrame([(t, 0, 1, 1, 1, 1, 1, u, c, 0.5, "k", "k", "k") for t, u, c in rows],
                               "tokens array<string>, arg1_start int, arg1_len int, rel_start int, rel_len int, arg2_start int, arg2_len int, "
                               "url string, corpus string, confidence double, arg1 string, rel string, arg2 string")
    assert df.select(G.instance_hash().alias("h")).distinct().count() == 6
    assert G.group_instances(df.union(df)).count() == 6
    assert G.summarize(df.union(df)).first().n_instances == 6


def test_repeated_prediction_lines_decode_alike(spark):
    from factweave.sources.codecs import decode_prediction
    dim = spark.createDataFrame([(1, "/a"), (2, "/b")], "enum int, type string")
    line = "arg\t/a@3, /b@2\trel:0.50\t7.00\tm.1,m.2"
    out = decode_prediction(spark.createDataFrame([(line,), (line,), ("x\t/zzz@1\t\t1\t",)], "value string"), dim).collect()
    assert [[(t.type, t.share) for t in r.types] for r in out] == [[("/a", 3), ("/b", 2)]] * 2


def test_null_tokens_are_invalid(spark):
    from factweave.operators.score import span_valid
    df = spark.createDataFrame([(None, 0), (["a", "b", "c"], 0), (["a"], 0)], "tokens array<string>, arg1_start int") \
        .selectExpr("*", "1 AS arg1_len", "1 AS rel_start", "1 AS rel_len", "2 AS arg2_start", "1 AS arg2_len")
    assert [r.v for r in df.select(span_valid().alias("v")).collect()] == [False, True, False]


def test_link_diff_and_size_rule_option(spark):
    from factweave.plans import registry as R
    from factweave.streaming.upsert import merge_batch
    from tests.conftest import SF_SMALL
    inst, parts = R.batched(spark, SF_SMALL)
    halves = [(inst.filter(c), parts.filter(c)) for c in ("batch < 12", "batch = 12")]
    _, _, flags = merge_batch(*halves, incoming_batch=12)
    _, _, ruled = merge_batch(*halves, incoming_batch=12, size_rule=True)
    every, some = (f.filter("relink").count() for f in (flags, ruled))
    assert every == flags.filter("in_incoming").count() and 0 < some <= every


def test_regroup_sends_no_wide_parts_or_hex_ids(spark):
    """AG3: its parts hold what it returns, and the group's id is not shuffled as text with every instance."""
    from tests.conftest import SF_SMALL
    from factweave.plans import registry as R
    _, parts = R.batched(spark, SF_SMALL, ("fbid",))
    assert parts.columns == ["gid", "batch", "arg1_fbid", "arg2_fbid"]
    _, whole = R.batched(spark, SF_SMALL)
    cols = ["gid", "batch", "arg1_fbid", "arg2_fbid"]
    assert sorted(map(repr, parts.collect())) == sorted(map(repr, whole.select(*cols).collect()))
    plan = R.ag3_regroup(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_orderkey#") > 0 and "arg1_name" not in plan  # the names were carried by every shuffle of the parts
