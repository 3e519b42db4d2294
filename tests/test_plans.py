"""Physical plans: what must and must not be in them."""

from __future__ import annotations

import re
from collections import Counter

import pytest

from __spark_entry__ import queries
from parcelmetrics import queries as analytics
from parcelmetrics.operators.joins import splittable_join
from parcelmetrics.operators.purchases import daily_fx, goods_per_package, with_payments
from parcelmetrics.operators.ranking import with_percentile_ranks
from parcelmetrics.plans import rollups
from parcelmetrics.plans.cases import CANONICAL, ITEMISED, KINDS, SHIPPED, CaseQueries, case_table
from parcelmetrics.plans.rollups import combine, revenue_split
from parcelmetrics.queries import case_rows, parent_rows, shipment_rows
from parcelmetrics.sources.sample import SAMPLE_OPTIONS, SampleViews, sample_tables
from parcelmetrics.sources.schemas import SCHEMAS
from parcelmetrics.sources.warehouse import read_tables

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_and_type_filters_reach_the_scan(spark):
    q = CaseQueries(sample_tables(spark, SF), SAMPLE_OPTIONS)
    text = plan(q.case_1())
    pushed = next(p for p in re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", text) if "package_type" in p)
    assert "EqualTo(package_type,SINGLE)" in pushed and "GreaterThanOrEqual(trans_at_utc" in pushed


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("warehouse")
    views = SampleViews(spark, SF)
    for name in SCHEMAS:
        views[name].write.parquet(str(folder / f"{name}.parquet"))
    return read_tables(spark, str(folder))


def final_plan(df) -> str:
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def reads(text: str) -> Counter:
    return Counter(re.findall(r"Location: InMemoryFileIndex\(1 paths\)\[file:[^\]]*/(\w+)\.parquet\]", text))


def test_all_cases_are_one_pass(spark, warehouse, no_broadcast):
    found = reads(final_plan(case_table(CaseQueries(warehouse, SAMPLE_OPTIONS))))
    # Families, singles, children, and children again for the sums of their parents: other rows or columns each time.
    assert found.pop("package") <= 4
    # Purchases serve the rows and the sums.
    assert max(found[t] for t in ("payment", "market_request", "currency")) <= 2
    assert {found[t] for t in ("package_fee", "package_fee_item", "shipping_cost", "request_domain", "customer", "country")} == {1}
    assert set(found) | {"package"} == set(SCHEMAS)


def test_a_single_case_leaves_out_what_others_need(spark, warehouse):
    q = CaseQueries(warehouse, SAMPLE_OPTIONS)
    assert set(reads(plan(q.case_1()))) == {"package", "package_fee", "shipping_cost", "currency", "customer", "country"}
    assert "shipping_cost" not in reads(plan(q.rows("3_1"))) and "market_request" not in reads(plan(q.case_3()))


def test_distinct_counts_copy_no_rows(spark):
    for name in ("case_summary", "case_summary_no_admin", "kpi_block"):
        assert "Expand" not in plan(queries()[name](spark, SF))


def test_suite_rows_read_the_case_table_once(spark):
    text = plan(rollups.suite_rows(rollups.combine_table(case_rows(spark, SF))))
    assert text.count("FileScan") == 1 and "Expand" not in text


def test_statistics_neither_stack_nor_count_all_values(spark):
    text = plan(queries()["package_statistics"](spark, SF))
    assert "stack(" not in text and "Expand" not in text


def test_a_report_reads_its_weeks_only(spark):
    for name in ("weekly_report_rows", "weekly_report_categories"):
        pushed = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan(queries()[name](spark, SF)))
        assert all("GreaterThanOrEqual(o_orderdate,1998-0" in p and "LessThan(o_orderdate,1998-06-15" in p for p in pushed) and pushed


def test_a_request_with_a_third_of_all_payments_is_split(spark, no_broadcast):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        requests = spark.range(0, 40000, 1, 8).selectExpr("id AS request_id", "uuid() AS product_name")
        paid = spark.range(0, 30000, 1, 8).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS paid_request_id", "DATE '2025-01-01' AS purchase_date", "uuid() AS pad")
        joined = with_payments(requests, paid)
        expected = 30000 + 40000 - paid.select("paid_request_id").distinct().count()
        assert joined.count() == expected
        assert "skew=true" in final_plan(joined)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_roll_up_reads_only_its_columns_and_parent_rows(spark):
    q = CaseQueries(sample_tables(spark, SF), SAMPLE_OPTIONS)
    for df in (combine(q.parents()), rollups.combine_table(q.rows(*SHIPPED))):
        text = plan(revenue_split(df))
        assert "/package_fee.parquet" in text and "package_fee_item" not in text
        # Only a single purchase's own rows need a domain, whose duplicates repeat them.
        assert text.count("/request_domain.parquet") == 1


def test_one_scan_feeds_a_roll_up_of_the_written_table(spark):
    text = plan(queries()["case_revenue_split"](spark, SF))
    assert text.count("FileScan") == 1
    schema = re.search(r"ReadSchema: struct<(.*?)>\s", text).group(1)
    assert len(re.findall(r"\w+:", schema)) == 6
    assert "PartitionFilters: [profit_case" in text


def test_dedupe_limits_groups_before_the_shuffle(spark):
    text = plan(daily_fx(sample_tables(spark, SF)["currency"]))
    below_exchange = text[text.index("Exchange") :]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange


def test_splittable_join_gives_both_sides_an_exchange(spark, no_broadcast):
    a = spark.range(1000).selectExpr("id % 7 AS k", "id AS row")
    b = spark.range(7).selectExpr("id AS k", "id * 2 AS v").groupBy("k").agg({"v": "max"}).withColumnRenamed("max(v)", "v")
    text = plan(splittable_join(a, b, "k", "k", spread="row"))
    join = text[text.index("SortMergeJoin") :]
    # The right side is already grouped by the key, yet gets an exchange of its own.
    assert len(re.findall(r"Exchange hashpartitioning\(.*_hash_(?:left|right)", join)) == 2


def test_splittable_join_splits_a_hot_key(spark, no_broadcast):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        left = spark.range(0, 60000, 1, 8).selectExpr("CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS k", "id AS row", "uuid() AS pad")
        right = spark.range(0, 60000, 1, 8).selectExpr("id AS k", "id + 1 AS v").groupBy("k").agg({"v": "max"})
        joined = splittable_join(left, right, "k", "k", spread="row")
        assert joined.count() == 60000
        joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_rows_without_a_key_are_spread(spark, no_broadcast):
    left = spark.range(0, 8000, 1, 4).selectExpr("CASE WHEN id < 0 THEN id END AS k", "id AS row")
    right = spark.range(5).selectExpr("id AS k", "id AS v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = splittable_join(left, right, "k", "k", spread="row")
        sizes = joined.selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(r["count"] for r in sizes) == 8000 and max(r["count"] for r in sizes) < 2000


def test_case_table_is_partitioned_by_case(spark):
    assert {r.profit_case for r in case_rows(spark, SF).select("profit_case").distinct().collect()} == {
        "1", "2", "3", "3_1", "4", "4_1", "5", "5_1"
    }


def test_suites_are_added_up_without_sorting_rows(spark):
    assert "SortAggregate" not in plan(rollups.suite_rows(rollups.combine_table(parent_rows(spark, SF))))


def test_two_percentiles_move_the_wide_rows_once(spark, no_broadcast):
    suites = spark.range(100).selectExpr("id AS k", "id % 7 AS a", "id % 3 AS b", "uuid() AS payload")
    text = plan(with_percentile_ranks(suites, ["k"], [], {"pa": "a", "pb": "b"}))
    assert len(re.findall(r"Sort \[k#\d+L ASC.*\n.*\n.*Project \[[^\]]*payload|SortMergeJoin.*LeftOuter", text)) == 1


def test_a_row_without_one_value_keeps_the_rank_of_the_other(spark):
    df = spark.createDataFrame([(1, None, 5), (2, 4, None), (None, 9, 9), (4, None, None)], "k long, a long, b long")
    ranked = with_percentile_ranks(df, ["k"], [], {"pa": "a", "pb": "b"})
    assert {(r.k, r.pa, r.pb) for r in ranked.collect()} == {(1, None, 50), (2, 50, None), (None, 100, 100), (4, None, None)}


def test_written_rows_hold_what_is_read_of_them(spark):
    """Roll-ups read parents and no itemised columns; volumes read all rows, and six columns."""
    parents = parent_rows(spark, SF)
    assert {r.profit_case for r in parents.select("profit_case").distinct().collect()} == set(SHIPPED)
    assert "storage_fee_krw" not in parents.columns and len(parents.columns) == len(rollups.COMBINED_FROM)
    assert len(shipment_rows(spark, SF).columns) == 6 and shipment_rows(spark, SF).count() == case_rows(spark, SF).count()


def test_a_sample_table_is_written_when_it_is_asked_for(spark, tmp_path):
    import parcelmetrics.sources.sample as sample

    tables = sample_tables(spark, SF)
    asked = []
    tables._write = lambda name, folder: (asked.append(name), sample.SampleViews(spark, SF)[name].write.parquet(f"{folder}/{name}.parquet"))
    tables._dir = SF + "/"
    assert tables["country"].count() == 25 and asked == ["country"] and set(tables) == set(SCHEMAS)


def test_purchase_amounts_do_not_pass_the_last_shuffle(spark, warehouse):
    df = revenue_split(rollups.combine_table(CaseQueries(warehouse, SAMPLE_OPTIONS).rows(*SHIPPED)))
    text = df._jdf.queryExecution().optimizedPlan().toString()
    to_customers = next(line for line in text.splitlines() if "_customer#" in line and "Project" in line)
    assert "handling_usd" not in to_customers and "_sums" not in to_customers and "storage_fee" not in to_customers


def test_rows_without_itemised_columns_are_the_same(spark, warehouse):
    """Four sums of terms give what terms of eighteen sums do, in every kind."""
    q = CaseQueries(warehouse, SAMPLE_OPTIONS)
    short = case_rows_of(q, itemised=False)
    whole = case_rows_of(q, itemised=True).select(short.columns)
    assert not set(short.columns) & ITEMISED and set(short.columns) | ITEMISED == set(CANONICAL)
    assert sorted(map(str, short.collect())) == sorted(map(str, whole.collect()))


def case_rows_of(q: CaseQueries, itemised: bool):
    return q.rows(*KINDS, itemised=itemised)


def test_purchases_do_not_move_for_their_rates(spark, warehouse, no_broadcast):
    text = plan(CaseQueries(warehouse, SAMPLE_OPTIONS).bought)
    assert not [line for line in text.splitlines() if "hashpartitioning(market_id" in line and "_hash_left" in line]


def test_single_purchases_ask_for_their_own_requests(spark, warehouse, no_broadcast):
    text = plan(CaseQueries(warehouse, SAMPLE_OPTIONS).rows(*SHIPPED, itemised=False))
    # Requests without a package of their own fall away first, and unpaid ones are not made for single packages.
    assert "LeftSemi" in text and text.count("LeftAnti") == 1


def test_parents_do_not_pass_the_shuffle_of_purchases(spark, warehouse, no_broadcast):
    text = CaseQueries(warehouse, SAMPLE_OPTIONS).rows(*KINDS)._jdf.queryExecution().optimizedPlan().toString()
    above = text[: text.index("_has_purchase")]
    assert "Union" in above


def test_line_items_move_once_for_children(spark, no_broadcast):
    text = plan(SampleViews(spark, SF)["child"])
    assert len(re.findall(r"Exchange hashpartitioning\(l_orderkey", text)) == 1


def test_goods_move_as_items(spark, warehouse, no_broadcast):
    """What items are made from does not reach the join with the children."""
    q = CaseQueries(warehouse, SAMPLE_OPTIONS)
    text = goods_per_package(q.children, q.bought)._jdf.queryExecution().optimizedPlan().toString()
    assert "handling_usd" not in text[: text.index("Join")] and "usd_krw_buy" not in text[: text.index("Join")]


def test_top_suites_are_ranked_without_their_other_columns(spark, no_broadcast):
    """Only the fifty rows of the result meet an exchange with all their columns."""
    columns = ["concat('S', id) AS suite_number", "CAST(id % 90 AS DECIMAL(18,0)) AS total_revenue", "CAST(id % 7 AS DECIMAL(18,0)) AS total_profit"]
    suites = spark.range(300).selectExpr(*columns, "uuid() AS payload")
    top = rollups.top_profiles(suites)
    assert re.search(r"Exchange hashpartitioning[^\n]*\n[^\n]*TakeOrderedAndProject[^\n]*payload", plan(top))
    every = rollups.top_suites(rollups.with_percentiles(suites.drop("payload"), []))
    top = top.select(every.columns)
    assert top.collect() == every.collect()


def broadcast_tables(text: str) -> set[str]:
    """Names of the tables that are read below a broadcast."""
    found, depth = set(), None
    for line in text.splitlines():
        at = re.search(r"[A-Za-z*]", line)
        if at and depth is not None and at.start() <= depth:
            depth = None
        if at and depth is None and "BroadcastExchange" in line:
            depth = at.start()
        if depth is not None:
            found |= reads(line).keys()
    return found


@pytest.mark.parametrize("itemised", [True, False])
def test_tables_that_grow_are_not_broadcast(spark, warehouse, itemised):
    """However small their files are: these say little about the rows that the driver would hold."""
    text = plan(CaseQueries(warehouse, SAMPLE_OPTIONS).rows(*KINDS, itemised=itemised))
    assert broadcast_tables(text) == {"currency", "country"}


def test_ranks_are_not_broadcast(spark):
    suites = spark.range(300).selectExpr("id AS k", "id % 9 AS v")
    ranked = with_percentile_ranks(suites, ["k"], [], {"p": "v"})
    assert "BroadcastHashJoin" not in plan(ranked)
    assert ranked.count() == 300


def test_older_results_and_exports_make_the_rows_of_their_cases_only(spark, monkeypatch):
    whole, older = case_rows(spark, SF), analytics.older_rows(spark, SF)
    same = whole.filter("profit_case IN ('1', '4')").select(older.columns)
    assert older.exceptAll(same).count() == 0 and same.exceptAll(older).count() == 0 and older.count() > 0
    assert len(older.columns) < len(CANONICAL) / 2

    def not_asked(*_):
        raise AssertionError("the table of all cases")

    monkeypatch.setattr(analytics, "case_rows", not_asked)
    for name in ("older_results", "exported_cases"):
        assert queries()[name](spark, SF).count() > 0
