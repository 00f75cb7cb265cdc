"""Queries on small odd tables against their own SQL, run by DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry


@pytest.fixture
def against_sql(spark, tmp_path):
    def rows(name, **tables):
        con = duckdb.connect()
        for t, (values, kinds) in tables.items():
            spark.createDataFrame(values, kinds).coalesce(1).write.parquet(f"{tmp_path}/{t}.parquet")
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
        got = entry.queries()[name](spark, str(tmp_path))
        expected = con.execute(f"SELECT {', '.join(got.columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
        key = lambda x: tuple((v is not None, v) for v in x)
        got = sorted((tuple(x) for x in got.collect()), key=key)
        assert got == sorted(expected, key=key)
        return got

    return rows


def counts_rows_of_joins(spark):
    """A function that tells how many rows the joins of all executions since now have put out."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()

    def counted():
        spark._jsc.sc().listenerBus().waitUntilEmpty()
        total, runs = 0, store.executionsList(int(before), 1000)
        for k in range(runs.size()):
            run = runs.apply(k).executionId()
            values, nodes = store.executionMetrics(run), store.planGraph(run).allNodes()
            for n in range(nodes.size()):
                node = nodes.apply(n)
                for m in range(node.metrics().size()) if "Join" in node.name() else ():
                    metric = node.metrics().apply(m)
                    if metric.name() == "number of output rows" and values.contains(metric.accumulatorId()):
                        total += int(values.apply(metric.accumulatorId()).replace(",", ""))
        return total

    return counted


#: 'the th' within 'the the th' counts once, at its first place: 251 before what follows in the first text, 250 in the second.
NEAR = [(1, "the the th" + "x" * 241 + "tion of"), (2, "the the th" + "x" * 240 + "tion of"), (3, "tion of" + "x" * 243 + "the the th"), (4, "tion of" + "é😀\n" * 81 + "the th"), (5, "tion of the"), (6, None), (7, ""), (8, "tion of" + "x" * 244 + "the the th")]


def test_near_terms_one_after_the_other(against_sql):
    documents = (NEAR, "doc_id long, text string")
    assert against_sql("near_terms", documents=documents) == [(1, False), (2, True), (3, True), (4, True), (5, False), (6, False), (7, False), (8, False)]


def test_relevance_counts_what_is_near_by_the_same_rule(against_sql):
    rows = [(k, "x " * 110 + text, "en", f"s{k}", 0) for k, text in NEAR if text is not None] + [(9, None, "en", "s9", 0)]
    got = against_sql("relevance_rollup", documents=(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    assert [x[-1] for x in got] == [10, 25, 25, 25, 10, 0, 10, 100]  # 15 more where both are near; an unknown text counts as its SQL has it


def test_halves_of_scores_are_rounded_to_even(against_sql):
    rows = [(1, 1, "P", 12500.0, "5-LOW"), (2, 1, "P", 17500.0, "5-LOW"), (3, 80, "F", 197500.0, "1-URGENT"), (4, 80, "F", 202500.0, "1-URGENT"), (5, 80, "F", None, "1-URGENT"), (6, None, "F", 450000.0, "2-HIGH"), (7, None, None, None, None)]
    got = against_sql("verdict_confidence", orders=(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"))
    assert [x[1:] for x in got] == [(2, "unverified (keyword only)"), (4, "unverified (keyword only)"), (80, "high"), (80, "high"), (80, "high"), (0, "medium"), (0, "low")]


def test_entities_end_with_a_semicolon(against_sql):
    html = '<html><title>{0}</title><body><p>x {0} y</p><a href="/a?b=1&amp;c&copy=2&amp">{0}</a></body></html>'
    rows = [(k, None, html.format(x)) for k, x in enumerate(("R&amp;D &amp", "A&amp", "&ampx; &copy 2024", "a & b && c &lt b", "&middot;&amp;lt;&quot;"))]
    got = against_sql("parsed_pages", pages=(rows, "page_id long, url string, html string"))
    assert [x[1] for x in got] == ["R&D &amp", "A&amp", "&ampx; &copy 2024", "a & b && c &lt b", '·&lt;"']


def test_many_organisations_of_few_names(spark, against_sql):
    orders = [(k, k % 40, "O", 1.0, "5-LOW") for k in range(4200)]
    suppliers = [(k, "s", k % 27, 1.0) for k in range(2700)]
    kinds = {"orders": (orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"), "supplier": (suppliers, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double")}
    counted = counts_rows_of_joins(spark)
    assert len(against_sql("organisation_matches", **kinds)) == 4200
    assert counted() < 20_000  # 4200 examples x 100 organisations of a place were joined before


def test_keywords_of_very_many_parts(spark, against_sql):
    part = [(k, ("red bolt", "old bolt red", "bolted", "one redder ground")[k % 4], "b", "t", 1, 1.0) for k in range(3000)]
    supplier = [(k, "s", 1, 1.0) for k in range(300)]
    counted = counts_rows_of_joins(spark)
    got = against_sql("catalogue_hits", part=(part, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"), supplier=(supplier, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"))
    assert len(got) == 6 * 300
    assert counted() < 20_000  # each of 300 suppliers met some 1500 parts by each keyword before


def test_very_many_equal_parts(spark, against_sql):
    part = [(k, ("red bolt", "old bolt", "red ring", "new plate", "bolt")[k % 5], f"b{k % 2}", f"t{k % 3}", k % 4, 1.0) for k in range(1500)]
    counted = counts_rows_of_joins(spark)
    got = against_sql("product_matches", part=(part, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"))
    assert len(got) == 1500
    assert counted() < 60_000  # each part met hundreds of its brand before
