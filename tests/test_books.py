"""The derived books: facts are views of the given tables, nothing as long as a fact table is written."""

import datetime as dt
import os

import pytest

from harness.books import Books
from harness.catalog import QUERIES
from tallystone.session import _steps_folder


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    """Thirty orders of two lines each."""
    root = str(tmp_path_factory.mktemp("base"))
    tables = {
        "region": ([(0, "ASIA")], "r_regionkey int, r_name string"),
        "nation": ([(0, "INDIA", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": (
            [(1, "C1", 0, "BUILDING", 100.0)],
            "c_custkey long, c_name string, c_nationkey int, c_mktsegment string, c_acctbal double",
        ),
        "supplier": ([(1, "S1", 0)], "s_suppkey long, s_name string, s_nationkey int"),
        "part": ([(1, 3, "PROMO")], "p_partkey long, p_size int, p_type string"),
        "orders": (
            [(k, 1, "F", 100.0 + k, dt.date(1996, 1 + k % 12, 5), "5-LOW") for k in range(1, 31)],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string",
        ),
        "lineitem": (
            [(k, 1, 1, n, 50.0, 0.1, 0.05, "N", dt.date(1996, 1 + k % 12, 9)) for k in range(1, 31) for n in (1, 2)],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_discount double, "
            "l_tax double, l_returnflag string, l_shipdate date",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return root


def _written(spark) -> set[str]:
    folder = _steps_folder(spark)
    return {name.rsplit("-", 1)[0] for name in os.listdir(folder)} if os.path.isdir(folder) else set()


def test_statements_and_rules_write_no_copy_of_a_fact_table(spark, base):
    before = _written(spark)
    assert QUERIES["income_statement"](spark, base).count() > 0
    assert QUERIES["invalid_currency"](spark, base).count() > 0
    facts = {"transactions", "receivables", "payables", "raw_transactions", "raw_accounts_receivable", "raw_accounts_payable"}
    assert not (_written(spark) - before) & facts


def test_legs_of_the_views(spark, base):
    legs = Books.of(spark, base)["transactions"]
    rows = legs.where("document_id = 'ARINV_7'").orderBy("leg").collect()
    assert [(r.leg, r.transaction_id, float(r.debit), float(r.credit)) for r in rows] == [
        (1, "TXN_ARINV_7_1", 107.0, 0.0), (2, "TXN_ARINV_7_2", 0.0, 107.0),
    ]
    kinds = {r.document_type: r["count"] for r in legs.groupBy("document_type").count().collect()}
    assert kinds["Revenue Invoice"] == kinds["Cash Receipt"] == kinds["Payroll"] == 60
    assert kinds["Vendor Invoice"] == 120 and "Inventory Consumption" not in kinds


def test_csv_files_are_compressed(spark, base):
    assert {r.dataset: (r.n_rows, r.n_ids, r.n_places) for r in QUERIES["csv_lineage"](spark, base).collect()}["customers"] == (1, 1, 1)
    folder = _steps_folder(spark)
    files = [f for name in os.listdir(folder) if name.startswith("csv_") for _, _, names in os.walk(f"{folder}/{name}") for f in names]
    assert files and not [f for f in files if f.endswith(".csv")]


def test_rules_scan_one_copy_of_the_invoices_in_many_files(spark, base, monkeypatch):
    """Equal to the view, and split into files, which as many tasks read; the ledger itself is not written."""
    monkeypatch.setattr("harness.books.ROWS_PER_FILE", 25)
    books = Books(spark, base)
    before = _written(spark)
    copy = books.with_written_invoices()
    assert copy is books.with_written_invoices() is copy.with_written_invoices()
    assert len(copy["payables_due"].inputFiles()) >= 3 and len(books["payables_due"].inputFiles()) > 0
    assert sorted(map(str, copy["payables_due"].collect())) == sorted(map(str, books["payables_due"].collect()))
    legs = lambda b: sorted(r.row_uid for r in b["raw_transactions"].select("row_uid").collect())
    assert legs(copy) == legs(books) and not (_written(spark) - before) & {"transactions", "raw_transactions"}
