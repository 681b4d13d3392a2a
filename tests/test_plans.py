import json

from tidegauge.plans.steps import plan_rejects, plan_steps


def steps(spark, document, flavor="mysql"):
    df = spark.createDataFrame([(1, 2, flavor, document)], "event_id long, thread_id long, flavor string, plan_json string")
    rows = [r.asDict() for r in plan_steps(df).collect()]
    return sorted(rows, key=lambda r: r["step_id"])


# One value of every field, in an order and with values of this test's own.
WHOLE = {
    "ref": ["shop.basket.owner", "func"],
    "cost_info": {"prefix_cost": "88.40", "data_read_per_join": "7M", "eval_cost": "3.50", "read_cost": "61.07", "query_cost": "912.6"},
    "key_length": "130",
    "used_key_parts": ["owner", "opened"],
    "using_index": False,
    "table_name": "basket",
    "filtered": "33.33",
    "rows_produced_per_join": 12,
    "key": "by_owner",
    "access_type": "range",
    "possible_keys": ["by_owner", "by_day", "PRIMARY"],
    "rows_examined_per_scan": 36,
}
SHOWN = {
    "query_cost": "912.6", "read_cost": "61.07", "eval_cost": "3.50", "prefix_cost": "88.40", "data_read_per_join": "7M",
    "possible_keys": "by_owner,by_day,PRIMARY", "used_key_parts": "owner,opened", "ref": "shop.basket.owner,func", "using_index": "false",
}


def test_every_field_is_shown(spark):
    (row,) = steps(spark, json.dumps({"outer": [{"inner": WHOLE}]}))
    plain = {k: v for k, v in WHOLE.items() if isinstance(v, (int, str)) and not isinstance(v, bool)}
    assert row == {"event_id": 1, "thread_id": 2, "step_id": 0, **plain, **SHOWN}


def test_no_steps_from_what_is_no_object(spark):
    for text in ('{"table_name": "t"', "", "[1]", '"x"', None, '{"broken": }', "{'table_name': 't'}", '{"table_name":"t"} x', "{}"):
        assert steps(spark, text) == [], text


def test_repeated_keys(spark):
    scan = '{"scan":{"table_name":"%s","access_type":"index"}}'
    text = '{"plan":{"read":%s,"hash":1,"read":%s,"hash":2,"read":%s}}' % tuple(scan % n for n in ("north", "east", "west"))
    assert [r["table_name"] for r in steps(spark, text, "mariadb")] == ["north", "east", "west"]
    assert [r["table_name"] for r in steps(spark, text, "mysql")] == ["west"]
    own = '{"table_name":"old","key":"k","table_name":"new"}'
    assert {f: steps(spark, own, f)[0]["table_name"] for f in ("mariadb", "mysql")} == {"mariadb": "old", "mysql": "new"}


def test_many_repeated_keys_stay_in_order(spark):
    parts = [f'"k{i % 7}":{{"table_name":"t{i}"}}' for i in range(700)]
    got = [r["table_name"] for r in steps(spark, "{" + ",".join(parts) + "}")]
    assert got == [f"t{i}" for i in range(693, 700)]


def test_row_counts_take_whole_numbers_only(spark):
    shown = {
        '"rows":1200': 1200,
        '"rows":3e2': 300,
        '"rows":-4': -4,
        '"rows_examined_per_scan":8,"rows":77': 8,
        '"rows_examined_per_scan":"8","rows":77': 77,
        '"rows_examined_per_scan":0.5,"rows":77': 77,
        '"rows_examined_per_scan":0,"rows":77': 0,
        '"rows":true': 0,
        '"rows":1e30': 0,
    }
    texts = ['{"key":"x","table_name":"t",%s}' % fields for fields in shown]
    df = spark.createDataFrame([(i, "mysql", t) for i, t in enumerate(texts)], "event_id long, flavor string, plan_json string")
    got = {r["event_id"]: r["rows_examined_per_scan"] for r in plan_steps(df).collect()}
    assert [got[i] for i in range(len(texts))] == list(shown.values())


def test_numbers_are_printed_with_fixed_places(spark):
    (row,) = steps(spark, '{"access_type":"const","cost":12.3456789,"filtered":6.5}', "mariadb")
    assert (row["query_cost"], row["filtered"]) == ("12.34568", "6.50")
    for number in ("1e20", "1e300", "1.8446744073709552e19"):
        (row,) = steps(spark, '{"filtered":%s,"cost":%s}' % (number, number))
        assert row["filtered"] == f"{float(number):.2f}" and row["query_cost"] == f"{float(number):.5f}"
    assert steps(spark, '{"filtered":"","access_type":""}') == []


def test_lists_with_other_kinds_are_empty(spark):
    text = '{"access_type":"all","possible_keys":["a","b"],"used_key_parts":["a",2],"ref":"const","using_index":"true"}'
    (row,) = steps(spark, text)
    assert (row["possible_keys"], row["used_key_parts"], row["ref"], row["using_index"]) == ("a,b", "", "", "false")


def test_text_after_the_document_makes_it_unreadable(spark):
    whole = '{"table_name":"w"}'
    tails = ("}", "]", "],{}", whole, "," + whole, ',"end":1}', " x")
    rows = [(i, f, whole + t) for i, t in enumerate(tails) for f in ("mysql", "mariadb")]
    df = spark.createDataFrame(rows, "event_id long, flavor string, plan_json string")
    assert plan_steps(df).count() == 0 and plan_rejects(df).count() == len(rows)
    assert len(steps(spark, f"  {whole}\n")) == 1


def test_long_and_deep_documents(spark):
    (row,) = steps(spark, '{"table_name":"%s"}' % ("x" * 21_000_000))
    assert len(row["table_name"]) == 21_000_000
    deep = '{"s":' * 1_100 + '{"table_name":"leaf"}' + "}" * 1_100
    rows = [("deep", deep), ("good", '{"table_name":"t"}'), ("none", None), ("cut", '{"table_name":')]
    df = spark.createDataFrame([(n, "mysql", d) for n, d in rows], "name string, flavor string, plan_json string")
    assert {r["name"] for r in plan_rejects(df).collect()} == {"deep", "cut"}
    assert [r["name"] for r in plan_steps(df).collect()] == ["good"]


def test_cost_is_inherited_downwards_only(spark):
    text = """{"query_block":{"cost_info":{"query_cost":"9.0"},"nested_loop":[
      {"table":{"table_name":"a","cost_info":{"query_cost":"1.0"},"sub":{"table":{"table_name":"a1"}}}},
      {"table":{"table_name":"b"}}, "text", 5, [{"table_name":"nested array"}]]},"tail":{"table_name":"z"}}"""
    got = [(r["step_id"], r["table_name"], r["query_cost"]) for r in steps(spark, text)]
    assert got == [(0, "a", "1.0"), (1, "a1", "1.0"), (2, "b", "9.0"), (3, "z", "")]


def test_strings_are_escaped_and_never_opened(spark):
    text = json.dumps({"table_name": 'a\\b"c`d', "attached": '{"table_name":"x"}', "note": "[{\"table_name\":\"y\"}]"})
    rows = steps(spark, text)
    assert [r["table_name"] for r in rows] == ['a\\\\b\\"c\\`d']


def test_deep_documents(spark):
    text = '{"table_name":"leaf"}'
    for _ in range(60):
        text = '{"sub":[' + text + "]}"
    assert [r["table_name"] for r in steps(spark, text)] == ["leaf"]


def test_a_plain_reader_is_used_only_where_no_key_repeats():
    """Colons within texts, escaped quotes and escaped backslashes hide no repeated key; depth is told before parsing."""
    from tidegauge.plans import steps as P

    read = P.Reader().document
    assert list(read('{"a":1,"b":{"c":"x\\":"},"a":2}', False).items()) == [("b", {"c": 'x":'}), ("a", 2)]
    assert list(read('{"a\\\\":1,"b":"\\":","a\\\\":2}', False).items()) == [("b", '":'), ("a\\", 2)]
    assert read('{"a":1,"b":"t:u"}', False) == {"a": 1, "b": "t:u"}
    assert read('{"a":[[{"c":1,"d":0,"c":2}]],"b":":"}', False) == {"a": [[{"d": 0, "c": 2}]], "b": ":"}
    assert list(read('{"a":1,"a":2}', True)) == [("a", 1), ("a", 2)]
    assert P._nesting('{"a":["[{\\"[", {"b\\\\":[]}]}') == 4
    assert read('{"a":' * 1000 + "1" + "}" * 1000, False) is not None and read('{"a":' * 1001 + "1" + "}" * 1001, False) is None


def test_documents_are_built_without_shuffling_texts(spark, tmp_path):
    """One exchange, of numbers: texts are made after it. Rows that repeat a line number are one line."""
    from tidegauge.queries import plans
    from tidegauge.queries.registry import Sample

    rows = [(2, 1, 7, 3.0), (2, 1, 9, 1.0), (2, 2, 8, 2.0), (3, 1, 5, 4.0), (None, 1, 6, 1.0)]
    spark.createDataFrame(rows, "l_orderkey bigint, l_linenumber bigint, l_partkey bigint, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    found = plans.documents(Sample(spark, str(tmp_path)))
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Exchange") == 1
    steps = plans.plan_steps(found).orderBy("event_id", "step_id").collect()
    assert [(s.event_id, s.step_id, s.table_name, s.rows_examined_per_scan) for s in steps] == [(2, 0, "t9\\`x", 3), (2, 1, "t8\\`x", 2), (3, 0, "t5", 0)]


def test_only_documents_of_reported_executions_are_built(spark, tmp_path):
    """The executions meet the lines before those are shuffled, merged and made into texts."""
    from tidegauge.plans.steps import plan_samples
    from tidegauge.queries import plans
    from tidegauge.queries.registry import Sample

    lines = [(k, n, k, 1.0) for k in (2, 3, 4, None) for n in (1, 2)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_linenumber bigint, l_partkey bigint, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = [(2, "shop", "select 1"), (3, None, "select 1"), (4, "shop", "select 1"), (4, "shop", "with x"), (6, "shop", "select 1"), (None, "shop", "select 1")]
    executions = spark.createDataFrame(rows, "event_id bigint, database_name string, query_sample_text string").selectExpr(
        "'a' AS instance", "current_timestamp() AS collected_at", "*", "1L AS thread_id", "'q' AS query_id"
    )
    executions.write.parquet(f"{tmp_path}/executions")
    executions = spark.read.parquet(f"{tmp_path}/executions")
    found = plan_samples(executions, plans.documents(Sample(spark, str(tmp_path))), ("event_id",))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.index("RepartitionByExpression") < plan.index("LeftSemi") < plan.rindex("l_orderkey")
    assert sorted((r.event_id, r.step_id) for r in found.collect()) == [(2, 0), (2, 1), (4, 0), (4, 0), (4, 1), (4, 1)]
