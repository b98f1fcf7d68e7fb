from tarkaloom.llm import catalog
from tests.test_catalog import DATA, con, norm, pytestmark, same  # noqa: F401


def test_lines_equal_sql(spark, con):  # noqa: F811
    for name, sql in catalog.oracle_sql().items():
        same(spark, con, catalog.queries()[name], sql)


def test_found_columns(spark):
    want = {
        "p1_found": "doc_id bigint, line_no bigint, noise_kind string", "p2_found": "rec_no bigint, com_pos bigint, lang_code string", "p4_found": "doc_id bigint, line_no bigint", "p5_found": "tbl string, row_key string",
        "p6_found": "edge_id string, side string, concept_id bigint", "p8_found": "item_id bigint, doc_id bigint", "p10_found": "doc_id_a bigint, doc_id_b bigint",
    }
    for name, cols in want.items():
        df = catalog.queries()[name](spark, DATA)
        assert ", ".join(f"{c} {t}" for c, t in df.dtypes) == cols, name
