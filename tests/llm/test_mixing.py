import numpy as np
import pytest

from wayforge.llm import mixing
from wayforge.llm.mixing import keep_mixture, mix_to_targets, op3_mixing, rake, scale_for, token_count


def cells(spark):
    rng = np.random.default_rng(3)
    return spark.createDataFrame([(f"s{i}", f"l{j}", float(rng.integers(1, 100)), 5) for i in range(4) for j in range(3)], "source string, lang string, tokens double, docs long")


def targets(spark, sources=(0.4, 0.3, 0.2, 0.1)):
    return {"source": spark.createDataFrame([(f"s{i}", x) for i, x in enumerate(sources)] + [("none", 0.5)], "source string, share double"), "lang": spark.createDataFrame([("l0", 0.5), ("l1", 0.25), ("l2", 0.25)], "lang string, share double")}


def shares(rows, dim):
    total = sum(r.weight * r.tokens for r in rows)
    out = {}
    for r in rows:
        out[r[dim]] = out.get(r[dim], 0) + r.weight * r.tokens / total
    return out


@pytest.mark.parametrize("most", [1000, 1])
def test_marginals_are_met_on_both_paths(spark, most):
    rows = rake(cells(spark), targets(spark), max_cells=most, rounds=12 if most == 1 else 60).collect()
    assert np.allclose([shares(rows, "source")[f"s{i}"] for i in range(4)], [0.4, 0.3, 0.2, 0.1], atol=1e-3)
    assert np.allclose([shares(rows, "lang")[f"l{i}"] for i in range(3)], [0.5, 0.25, 0.25], atol=1e-3)


def test_values_without_a_target_go(spark):
    t = targets(spark)
    rows = rake(cells(spark), {"source": t["source"].where("source <> 's0'"), "lang": t["lang"]}).collect()
    assert all(r.weight == 0 for r in rows if r.source == "s0") and sum(r.weight for r in rows) > 0


def test_budget(spark):
    raked = rake(cells(spark), targets(spark)).cache()
    total = raked.agg({"tokens": "sum"}).first()[0]
    c = scale_for(raked, 0.8 * total)
    assert abs(sum(r.tokens * min(1, c * r.weight) for r in raked.collect()) - 0.8 * total) < 0.01 * total


def test_sampled_shares_follow_the_targets(spark):
    d = "/root/testdata/sf0.1"
    rows = op3_mixing(spark, d).collect()
    assert len(rows) == 10_000 and all(0 <= r.probability <= 1 for r in rows)
    for dim, power in (("source", 0.7), ("lang", 0.8)):
        have = {}
        for r in rows:
            have[r[dim]] = have.get(r[dim], 0) + r.tokens
        total = sum(have.values())
        aim = {k: (v / total) ** power for k, v in have.items()}
        got, expected = {}, {}
        for r in rows:
            expected[r[dim]] = expected.get(r[dim], 0) + r.tokens * r.probability
            if r.sampled:
                got[r[dim]] = got.get(r[dim], 0) + r.tokens
        for k in aim:
            want = aim[k] / sum(aim.values())
            assert abs(expected[k] / sum(expected.values()) - want) < 1e-3
            assert abs(got[k] / sum(got.values()) - want) < 0.25 * want + 0.01


def test_nulls_repeats_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b", None, "x"), (1, "a b", None, "x"), (None, "c d e", "s", None), (2, None, "s", "x"), (3, "", "s", "x")], "doc_id long, text string, source string, lang string")
    rows = mix_to_targets(docs.withColumn("tokens", token_count()), {"source": 0.5, "lang": 0.5}).collect()
    assert len(rows) == 5 and {r.sampled for r in rows if r.doc_id == 1} in ({True}, {False})
    assert mix_to_targets(docs.limit(0).withColumn("tokens", token_count()), {"source": 0.5}).count() == 0
    clash = docs.withColumns({"weight": mixing.F.lit("w"), "topic": mixing.F.lit(1), "sampled": mixing.F.lit(2)})
    kept = keep_mixture(spark, clash)
    assert kept.columns == clash.columns and kept.where("topic = 1").count() == kept.count()


def test_query_equals_independent_raking(spark, sf_dir):
    """Cells, targets, raking and probabilities once more with dictionaries."""
    import re

    def kind(t):
        t = t or ""
        return "licensed" if re.search("(?i)licen[cs]e", t) else "tabular" if " | " in t else "long" if len(t) > 10_000 else "prose"

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    cell, tokens = {}, {}
    for r in docs:
        cell[r.doc_id] = (r.source, r.lang, kind(r.text))
        tokens[r.doc_id] = len(re.findall(r"[^ \t\n\x0b\f\r]+", r.text or ""))
    sums = {}
    for i, c in cell.items():
        sums[c] = sums.get(c, 0) + tokens[i]
    total = sum(sums.values())
    aims = []
    for d, power in enumerate((0.7, 0.8, 0.9)):
        have = {}
        for c, n in sums.items():
            have[c[d]] = have.get(c[d], 0) + n
        raised = {k: (v / total) ** power for k, v in have.items() if v}
        aims.append({k: v / sum(raised.values()) for k, v in raised.items()})
    weight = {c: 1.0 for c in sums}
    for _ in range(200):
        for d, aim in enumerate(aims):
            have = {}
            for c, n in sums.items():
                have[c[d]] = have.get(c[d], 0) + n * weight[c]
            weight = {c: w * (aim.get(c[d], 0) * total / have[c[d]] if have[c[d]] else 0) for c, w in weight.items()}
    top = max(w for c, w in weight.items() if sums[c])
    for r in op3_mixing(spark, sf_dir).collect():
        c = cell[r.doc_id]
        assert (r.source, r.lang, r.topic) == c and r.tokens == tokens[r.doc_id]
        assert abs(r.weight - weight[c]) < 1e-3 * max(weight[c], 1e-9)
        assert abs(r.probability - (weight[c] / top if sums[c] else 1.0)) < 2e-3


def test_null_is_no_text_and_columns_may_have_any_name(spark):
    docs = spark.createDataFrame([(i, (None, "<null>", "=", "")[i % 4], 10, "kept") for i in range(40)], "doc_id long, source string, tokens long, _source string")
    out = mix_to_targets(docs, {"source": 0.5})
    assert out.columns == [*docs.columns, "weight", "probability", "sampled"] and {r._source for r in out.collect()} == {"kept"}
    skewed = docs.where("source is null").union(docs.where("source = '<null>'").withColumn("tokens", mixing.F.lit(1000).cast("long"))).union(docs.where("source = ''"))
    weights = {r.source: r.weight for r in mix_to_targets(skewed, {"source": 0.5}).collect()}
    assert len(weights) == 3 and weights[None] > weights["<null>"]


def test_unsettled_weights_are_told(spark):
    from pytest import warns

    one = spark.createDataFrame([("a", "x", 1.0, 1), ("b", "y", 1.0, 1)], "source string, lang string, tokens double, docs long")
    off = {"source": spark.createDataFrame([("a", 0.9), ("b", 0.1)], "source string, share double"), "lang": spark.createDataFrame([("x", 0.1), ("y", 0.9)], "lang string, share double")}
    with warns(UserWarning, match="marginals are off"):
        rake(one, off, rounds=5)
