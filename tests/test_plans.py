"""Plan shapes that must hold at scale."""

import re

import pytest

from labtables.queries import QUERIES
from labtables.queries.parsing import labelled_text, tagged_text
from labtables.queries.series import series_text

SF_DIR = "/root/testdata/sf0.001"


def plan(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["row_split", "group_split", "state_parse", "file_name_parts", "page_classify",
                                  "pattern_flags", "calibrate_points", "page_links", "page_spectrum_files"])
def test_no_shuffle(spark, name):
    assert "Exchange" not in plan(spark, name)


@pytest.mark.parametrize("name, most", [
    ("resample_linear", 2), ("resolution_gate", 2), ("series_vector", 2), ("doc_last_wins", 1),
    ("manifest_latest", 1), ("source_universe", 1), ("distinct_rows", 1),
])
def test_number_of_shuffles(spark, name, most):
    assert len(re.findall(r"Exchange (?:hash|range)", plan(spark, name))) <= most


def test_cells_are_combined_before_the_shuffle(spark):
    text = plan(spark, "resample_linear")
    assert text.index("partial_min") > text.index("Exchange hashpartitioning(l_suppkey")
    assert "hashpartitioning(l_suppkey#" in text and ", cell#" in text


def test_semi_joins(spark):
    assert "LeftSemi" in optimized(spark, "semi_valid") and "LeftAnti" in optimized(spark, "anti_rest")


def test_repeated_keys_are_folded_before_a_semi_or_anti_join(spark):
    text = plan(spark, "anti_rest")
    assert re.search(r"HashAggregate\(keys=\[o_orderkey#\d+L\], functions=\[\]", text)


def test_filter_reaches_the_scan_and_columns_are_pruned(spark):
    text = plan(spark, "three_way_join")
    assert "EqualTo(o_orderstatus,F)" in text and "o_orderpriority" not in text


def test_no_cross_join_in_any_plan(spark):
    for name in ("resample_linear", "spectra_table", "docs_full_merge", "usage_table", "external_ids"):
        text = plan(spark, name)
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_files_are_parsed_once(spark):
    """A filter on the reject reason stays above the parser instead of repeating it."""
    for name in ("spectra_table", "labelled_points", "tagged_properties", "coords_parse"):
        text = plan(spark, name)
        # the pattern of a data block, of the properties (names and values) and the decoder
        mark, most = ("decode(", 2) if "coords" in name else ("XYDATA", 2) if "XYDATA" in text else ("> <(", 4)
        assert 0 < text.count(mark) <= most, (name, mark, text.count(mark))


def test_python_runs_only_where_a_function_was_given(spark):
    for name in QUERIES:
        if name in ("enrich_pandas", "universe_table", "semi_valid", "insert_ignore_duplicates", "json_roundtrip",
                    "insert_documents_in_parts", "document_roundtrip", "binary_scan", "binary_audit", "text_lines",
                    "tagged_files", "id_ledger", "document_json_roundtrip"):
            continue
        if name.startswith(("ledger_", "bulk_", "bucket_", "registry_")):  # write stores first
            continue
        assert "Python" not in plan(spark, name) and "MapInPandas" not in plan(spark, name), name


@pytest.mark.parametrize("name", ["enrich_pandas", "universe_table"])
def test_enrichment_is_one_python_node(spark, name):
    text = plan(spark, name)
    assert len(re.findall(r"MapInPandas|ArrowEvalPython|MapInArrow", text)) == 1


def test_counts_of_spectra_read_no_vector(spark):
    text = optimized(spark, "docs_full_merge")
    counts = [line for line in text.splitlines() if "rows_of_key" in line and "Aggregate" in line]
    assert counts and not any("vec" in line or "freqs" in line for line in counts)


def test_no_scan_is_dealt_out_anew(spark):
    for name in ("labelled_headers", "property_table", "coords_parse", "resample_linear", "spectra_table"):
        assert "RoundRobin" not in plan(spark, name), name


def test_tables_in_buckets_join_without_an_exchange(spark):
    text = plan(spark, "bucketed_join")
    assert "SortMergeJoin" in text and "Exchange" not in text and text.count("Bucketed: true") == 2


@pytest.mark.parametrize("make", [series_text, labelled_text, tagged_text])
def test_texts_of_a_table_of_one_task_are_written_by_many(spark, tmp_path, make):
    spark.range(200).selectExpr(
        "id AS c_custkey", "cast(id % 25 AS int) AS c_nationkey", "cast(id AS double) AS c_acctbal", "'BUILDING' AS c_mktsegment",
    ).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(200).selectExpr(
        "id AS o_orderkey", "id AS o_custkey", "'O' AS o_orderstatus", "cast(id AS double) AS o_totalprice", "'1-URGENT' AS o_orderpriority",
    ).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    made = make(spark, str(tmp_path))
    made.write.text(f"{tmp_path}/texts", lineSep="\x00")
    assert made.count() == 200 and len([*(tmp_path / "texts").glob("part-*")]) > 4
