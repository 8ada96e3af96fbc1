"""Typing without samples and caps: weights, scores and the stop by weight against plain versions; stored phase one."""

import dataclasses
import itertools
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from factweave.operators import typing as T
from factweave.plans import registry as R
from factweave.session import scratch_path
from factweave.sources import codecs as CD
from tests.conftest import SF_SMALL


def test_weights_equal_all_pairs_of_occurrences(spark):
    rng = random.Random(3)
    sets = [sorted(rng.sample(["/a", "/b", "/c", "/d", "/e", "/f"], rng.choice([1, 1, 2, 3]))) for _ in range(14)]
    rows = [(f"rel {rng.choice('xxxxyz')}", f"m.{rng.randrange(40)}", t, ",".join(t)) for t in (rng.choice(sets) for _ in range(300))]
    rows.append(("rel alone", "m.1", ["/a"], "/a"))
    df = spark.createDataFrame(rows, "rel string, fbid string, types array<string>, tkey string")
    want, by = {}, defaultdict(list)
    for rel, _, t, _ in rows:
        by[rel].append(set(t))
    for rel, x in by.items():
        shared, pairs = sum(bool(a & b) for a, b in itertools.combinations(x, 2)), len(x) * (len(x) - 1) // 2
        want[rel] = (len(x), shared, pairs, shared / pairs if pairs else 0.0, (200 * shared + pairs) // (2 * pairs) / 100 if pairs else 0.0)
    for ent in (df, T.entity_counts(df)):
        got = {r.rel: (r.n_sample, int(r.shared), r.pairs, r.weight, r.weight_2dp) for r in T.relation_stats(ent).collect()}
        assert got == want


def world(seed, rels, args, ents, weights):
    rng = random.Random(seed)
    weight = {f"rel {i}": rng.choice(weights) for i in range(rels)}
    arg_rels = {f"arg {i}": rng.sample(list(weight), rng.randint(1, min(6, rels))) for i in range(args)}
    ent_rels = {(f"m.{i // 2}", ("/t", "/u")[i % 2]): rng.sample(list(weight), rng.randint(1, min(5, rels))) for i in range(ents)}
    return weight, arg_rels, ent_rels


def frames(spark, weight, arg_rels, ent_rels):
    size = defaultdict(int)
    for rels in ent_rels.values():
        for r in rels:
            size[r] += 1
    rel_ent = spark.createDataFrame([(r, f, [t], t) for (f, t), rels in ent_rels.items() for r in rels], "rel string, fbid string, types array<string>, tkey string")
    arg_rel = spark.createDataFrame([(a, r, weight[r], size[r]) for a, rels in arg_rels.items() for r in rels if size[r]],
                                    "arg string, rel string, weight_2dp double, n_entities long")
    return arg_rel, rel_ent


@pytest.mark.parametrize("seed,rels,args,ents,weights", [
    (1, 12, 40, 60, [0.1, 0.22, 0.25]),                          # like weights: nothing can be left out
    (2, 40, 60, 400, [0.0, 0.1, 0.3, 0.6, 0.9, 1.0]),            # heavy and light relations
    (3, 8, 30, 9, [0.1, 0.9]),                                   # fewer entities than asked for
    (4, 3, 50, 80, [0.5]),                                       # few classes, many ties
])
def test_top_entities_equal_all_scores(spark, seed, rels, args, ents, weights):
    weight, arg_rels, ent_rels = world(seed, rels, args, ents, weights)
    arg_rel, rel_ent = frames(spark, weight, arg_rels, ent_rels)
    c = T.signature_classes(arg_rel, rel_ent)
    k, want = 5, {}
    term = {r: Decimal(str(round(10 ** (4 * w), 6))).quantize(Decimal("0.000001")) for r, w in weight.items()}
    for a, mine in arg_rels.items():
        scored = sorted((-s, f, t) for (f, t), theirs in ent_rels.items() if (s := sum(term[r] for r in mine if r in theirs)))
        want[a] = [(f, t, -s) for s, f, t in scored[:k]]
    got = defaultdict(list)
    for r in T.of_args(T.class_top_entities(c, T.TyperSettings(max_similar_entities=k)), c).orderBy("arg", "rank").collect():
        got[r.arg].append((r.fbid, r.tkey, r.score))
    assert got == {a: w for a, w in want.items() if w}
    if seed == 2:  # light relations were really left to the classes that can still rise
        every, left = T.class_scores(c).count(), T.top_classes(c, k).count()
        assert left < every


def test_equal_relation_sets_are_one_class(spark):
    arg_rel, rel_ent = frames(spark, {"r1": 0.2, "r2": 0.3}, {f"a{i}": ["r1", "r2"] if i % 2 else ["r2"] for i in range(50)}, {("m.x", "/t"): ["r1"]} | {(f"m.{i}", "/t"): ["r2"] for i in range(90)})
    c = T.signature_classes(arg_rel, rel_ent)
    assert c.args.select("cls").distinct().count() == 2 and {r.members for r in c.ent_classes.collect()} == {1, 90}
    assert T.class_scores(c).count() == 3 and T.of_args(T.class_top_entities(c, T.TyperSettings()), c).count() == 50 * 15


def test_stored_phase_one_is_refused_for_other_settings(spark):
    tup, dim = R.typing_inputs(spark, SF_SMALL)
    path = scratch_path(spark, "phase-one-test")
    T.predict_types(tup, R.TYPING, dim, stage="one", stored=path)
    two = T.predict_types(None, dataclasses.replace(R.TYPING, max_predicted_types=1), dim, stage="two", stored=path)  # a phase-two setting
    assert {len(r.types) for r in two.collect()} == {1}
    with pytest.raises(ValueError, match="was made with"):
        T.predict_types(None, dataclasses.replace(R.TYPING, min_rel_weight=0.2), dim, stage="two", stored=path)
    with pytest.raises(ValueError):
        T.predict_types(tup, R.TYPING, dim, stage="three")
    with pytest.raises(ValueError):
        T.predict_types(None, R.TYPING, dim, stage="two")


def test_caps_and_sample_are_settings(spark):
    tup, dim = R.typing_inputs(spark, SF_SMALL)
    full = T.phase_one(tup, R.TYPING, dim, materialize=False)
    cut = T.phase_one(tup, dataclasses.replace(R.TYPING, sample_relations=True, max_entities_write_per_rel=20, max_args_per_rel_info=7, min_rel_weight=0.0), dim, materialize=False)
    assert cut.stats.agg(F.max("n_sample")).first()[0] == 20 and full.stats.agg(F.min("n_sample")).first()[0] > 150
    assert cut.arg_rel.groupBy("rel").count().agg(F.max("count")).first()[0] <= 7 < full.arg_rel.groupBy("rel").count().agg(F.max("count")).first()[0]


def test_lines_of_a_large_relation_are_short_and_whole(spark):
    n = 5000
    ent = spark.range(n).selectExpr("'is in' AS rel", "concat('m:', id) AS fbid", "array('/a/b') AS types", "'/a/b' AS tkey")
    info = spark.createDataFrame([("is in", 0.5, n)], "rel string, weight_2dp double, n_entities long")
    dim = spark.createDataFrame([(1, "/a/b", 5)], "enum int, type string, instances int")
    lines = CD.relation_lines(info, ent, dim).cache()
    assert lines.count() == 50 and lines.agg(F.max(F.size(F.split("line", ":")))).first()[0] < 2 * CD.ENTITIES_PER_LINE
    arg_rel = spark.createDataFrame([("a\tb", "is in", 0.5, n)], "arg string, rel string, weight_2dp double, n_entities long")
    back = CD.read_phase_one_lines(CD.phase_one_lines(arg_rel, lines), dim)
    assert back.rel_ent.distinct().count() == n and back.rel_info.first().n_entities == n
    assert [tuple(r) for r in back.arg_rel.collect()] == [("a\tb", "is in", 0.5, n)]


def test_relation_infos_do_not_read_the_tuples_again(spark):
    """SRC12: weights, sizes and entity sets come from the stored counts; each branch read the tuples before."""
    from factweave.plans import registry as R
    from tests.conftest import SF_SMALL
    plan = R.src12_relinfo_decode(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "l_partkey" not in plan


def test_phase_one_lines_are_parsed_once(spark):
    """SRC11: what phase two reads of the lines is stored; a type set is looked up once, however many entities have it. Unknown types and bad lines are dropped."""
    ent = spark.createDataFrame([("r:1", f"m{i}", ["/a", "/b"] if i % 2 else ["/a", "/x"], "k") for i in range(6)] + [("r:1", "m9", ["/x"], "k")],
                                "rel string, fbid string, types array<string>, tkey string")
    info = spark.createDataFrame([("r:1", 0.5, 7)], "rel string, weight_2dp double, n_entities long")
    dim = spark.createDataFrame([(1, "/a", 5), (2, "/b", 5)], "enum int, type string, instances int")
    args = spark.createDataFrame([("a\tb", "r:1", 0.5, 7)], "arg string, rel string, weight_2dp double, n_entities long")
    lines = CD.phase_one_lines(args, CD.relation_lines(info, ent, dim))
    assert "explode" not in lines._jdf.queryExecution().optimizedPlan().toString()
    bad = spark.createDataFrame([("\tr:high:m1,1",), ("\tr",), ("\tr:0.5:m1,one",), ("a\tb\tc",), (None,)], "value string")
    back = CD.read_phase_one_lines(lines.unionByName(bad), dim)
    for df in (back.rel_ent, back.rel_info, back.arg_rel):
        assert "split(" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.rel, r.fbid, r.tkey, tuple(r.types)) for r in back.rel_ent.collect()) == \
        [("r:1", f"m{i}", *(("/a,/b", ("/a", "/b")) if i % 2 else ("/a", ("/a",)))) for i in range(6)]
    assert [tuple(r) for r in back.rel_info.collect()] == [("r:1", 0.5, 6)] and [tuple(r) for r in back.arg_rel.collect()] == [("a\tb", "r:1", 0.5, 6)]
