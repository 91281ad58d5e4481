"""Each change of a log without faults makes one code."""

import json

from wayforge.operators.requestlogs import log_issues
from wayforge.plans.log_queries import CHANGES, DENIED, ID, changed


def test_one_change_one_code(spark):
    rows = [(i, r, "77", e.replace(ID, "77"), s) for i in range(len(CHANGES)) for r, e, s in [changed(i)]]
    plain = {kind: next(changed(i)[1:] for i, c in enumerate(CHANGES) if c[1] == kind) for kind in ("venue", "booked", "failed")}
    for i, c in enumerate(CHANGES):
        if c[0]:
            assert changed(i)[1:] != plain[c[1]], f"nothing changes for {c[0]}"
    logs = spark.createDataFrame(rows, "k int, route string, detail_id string, evidence string, stored string")
    got = {}
    for r in log_issues(logs, "k", DENIED).collect():
        got.setdefault(r.k, set()).add(r.code)
    assert got == {i: {c[0]} for i, c in enumerate(CHANGES) if c[0]}


def test_broken_logs_do_not_crash(spark):
    odd = [None, "", "{", "[]", "{}", '{"queries": 5}', '{"queries": {"reviews": [{"variables": "x"}, 7], "detail": [{"evidenceResponse": {"data": {"fullProduct": [{"productCode": "C"}]}}}], "pax": [{}]}}']
    logs = spark.createDataFrame([(i, r, "1", x, None) for i, x in enumerate(odd) for r in ("venue", "product")], "k int, route string, detail_id string, evidence string, stored string")
    codes = {(r.k, r.code) for r in log_issues(logs, "k", DENIED).collect()}
    assert (6, "graphql-price-query-missing") in codes and (4, "graphql-query-missing") in codes


def test_logs_of_one_file_are_worked_on_by_all_cores(spark, sf_dir):
    from wayforge.plans.log_queries import request_log_derived
    from wayforge.plans.registry import spread

    cores = spark.sparkContext.defaultParallelism
    sizes = spread(spark.range(50_000).coalesce(1), 1000).rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert len(sizes) == max(2 * cores, 50) and max(sizes) <= 1500
    assert "REPARTITION_BY_NUM" in request_log_derived(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


def test_names_and_errors_are_found_however_they_are_written(spark):
    """Escaped names of fields, names at any depth and in any letters; values and other names are none."""
    answers = {
        '{"data":{"a":[{"User_Name":1}]}}': {"graphql-privacy"}, r'{"data":{"us\u0065rname":1}}': {"graphql-privacy"}, r'{"data":{"user\u005fname":1}}': {"graphql-privacy"},
        '{"data":{"AVATARURL":null}}': {"graphql-privacy"}, '{"data":{"note":"username"}}': set(), '{"data":{"username2":1}}': set(), '{"data":{"user name":1}}': set(), '{"username":': set(),
        r'{"\u0065rrors":[{"path":["x"]}]}': {"graphql-errors"}, '{"errors":[]}': set(), '{"errors":[{}]}': {"graphql-errors"}, '{"data":{"errors":[{"path":["x"]}]}}': set(), '{"note":"errors"}': set(), '{"errors":null}': set(),
    }
    # an answer that is kept as a text stays as it was written
    rows = [(i, "product", "1", json.dumps({"queries": {"detail": [{"evidenceResponse": a}], "pax": [{"evidenceResponse": a}]}}), "{}") for i, a in enumerate(answers)]
    logs = spark.createDataFrame(rows, "k int, route string, detail_id string, evidence string, stored string")
    for denied in (DENIED, [*DENIED, "e-mail"]):
        got = {i: set() for i in range(len(rows))}
        for r in log_issues(logs, "k", denied).collect():
            if r.code in ("graphql-privacy", "graphql-errors"):
                got[r.k].add(r.code)
        assert got == dict(enumerate(answers.values()))


def test_nodes_are_not_made_to_look_for_names(spark, sf_dir):
    """A row of six columns for each value of each answer took half of the time; the rules are not interpreted in explode either."""
    from wayforge.plans.log_queries import request_log_derived

    plan = request_log_derived(spark, sf_dir)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "json_names" in text and "json_nodes" not in text
    explode = next(x for x in text.split("\n") if "Generate explode" in x)
    assert "CASE WHEN" not in explode


def test_names_are_those_of_all_nodes():
    from wayforge.functions.nested import _names, _nodes_of

    some = ['{"a":{"b":[{"a":1},{"c_d":NaN}]},"\\u0065":2}', "[[[]]]", "{", "", " {\"x\":1} ", '{"n":' + "1" * 5000 + "}", "[" * 100_000, None]
    for texts in ([x] for x in some):
        assert _names(texts) == sorted({r["name"] for r in _nodes_of(texts) if r["name"] is not None})
    assert _names(some) == ["a", "b", "c_d", "e", "n", "x"]
