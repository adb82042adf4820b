import glob
import os

import duckdb
import pytest

from vacantis.llm import queries

COLUMNS = {
    "p1_found": ["employer_row_id", "group_row_id", "location_row_id", "title_row_id"],
    "p2_found": ["name_a", "name_b"],
    "p3_found": ["row_id_a", "row_id_b"],
    "p4_found": ["field", "row_id"],
    "p5_found": ["line_no", "row_id"],
    "p6_found": ["field", "row_id"],
    "p7_found": ["entry_id", "field", "row_id"],
    "p8_found": ["doc_id", "item_id"],
    "p9_found": ["source"],
    "p10_found": ["doc_id", "lang"],
}


@pytest.mark.parametrize("name", COLUMNS)
def test_found_has_its_columns_and_no_row_twice(spark, root, name):
    rows = [tuple(r) for r in queries.queries()[name](spark, root).select(*COLUMNS[name]).collect()]
    assert rows and len(rows) == len(set(rows))
    sql = queries.oracle_sql().get(name)
    if sql:
        con = duckdb.connect()
        for p in glob.glob(f"{root}/*.parquet"):
            con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
        assert set(rows) == set(con.execute(f"SELECT {', '.join(COLUMNS[name])} FROM ({sql})").fetchall())
