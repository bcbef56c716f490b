"""CSV scans with lineage and differing headers, publication of whole runs, and the plan from raw tables to published books."""

from __future__ import annotations

import json
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallystone.config import SimulationSettings
from tallystone.operators import cash_plan, completeness, forecasting, journal
from tallystone.plans import books
from tallystone.schema import EXPECTED_COLUMNS
from tallystone.sources import publish, raw
from tests.test_finance import EVENT_SCHEMA, event

HEAD = "entity_id,entity_name,country,functional_currency"


@pytest.fixture
def entity_files(tmp_path):
    folder = tmp_path / "entities.csv"
    folder.mkdir()
    (folder / "a.csv").write_text(HEAD + '\nE1,"One\nline",DE,EUR\nE2,Two,FR,NA\nE2,Two,FR,NA\n')
    (folder / "b.csv").write_text("country,entity_id,functional_currency,entity_name\nIT,E3,EUR,Three\n")
    (folder / "c.csv").write_text('entity_id,"entity_name",own\nE4,Four,x\nE5\nE6,Six,y,z\n')
    (folder / "d.csv").write_text(HEAD + "\n")
    (folder / "e.csv").write_text("")
    return str(folder)


def test_files_of_several_headers(spark, entity_files):
    scan = raw.scan_csv(spark, entity_files, "entities")
    rows = {(r.source_file.rsplit("/", 1)[1], r.row_index): r for r in scan.collect()}
    assert sorted(rows) == [("a.csv", 0), ("a.csv", 1), ("a.csv", 2), ("b.csv", 0), ("c.csv", 0), ("c.csv", 1), ("c.csv", 2)]
    data = {k: (r.entity_id, r.entity_name, r.country, r.functional_currency, r.own) for k, r in rows.items()}
    assert data["a.csv", 0] == ("E1", "One\nline", "DE", "EUR", None) and data["a.csv", 1] == ("E2", "Two", "FR", None, None)
    assert data["b.csv", 0] == ("E3", "Three", "IT", "EUR", None) and data["c.csv", 0] == ("E4", "Four", None, None, "x")
    assert data["c.csv", 1] == ("E5", None, None, None, None) and data["c.csv", 2][:2] == ("E6", "Six")
    assert [k for k in sorted(rows) if rows[k].corrupt_record is not None] == [("c.csv", 1), ("c.csv", 2)]
    # Copies share their content key; file and number tell them apart, and are the same on the next reading.
    assert rows["a.csv", 1].row_uid == rows["a.csv", 2].row_uid != rows["a.csv", 0].row_uid
    again = raw.scan_csv(spark, entity_files, "entities").select(raw.physical_id().alias("id"), "row_uid")
    assert sorted(again.collect()) == sorted(scan.select(raw.physical_id().alias("id"), "row_uid").collect())
    plain = raw.scan_csv(spark, entity_files, "entities", places=False)
    assert sorted(map(str, plain.collect())) == sorted(map(str, scan.drop("row_index").select(*plain.columns).collect()))
    bad = completeness.malformed_records(scan, "entities").collect()
    assert sorted(r.reason for r in bad) == ["record 1 of c.csv does not fit its header", "record 2 of c.csv does not fit its header"]


def test_absent_columns_of_files(spark, entity_files):
    absent = raw.absent_columns(raw.csv_headers(spark, entity_files), "entities")
    found = completeness.schema_issues_of_files(absent, "entities")
    assert sorted((r.field, r.reason) for r in found.collect()) == [
        ("country", "column country is absent from c.csv"), ("functional_currency", "column functional_currency is absent from c.csv")]


def test_scan_edges(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    none = raw.scan_csv(spark, str(tmp_path / "empty.csv"), "entities")
    assert none.collect() == [] and set(EXPECTED_COLUMNS["entities"]) <= set(none.columns)
    (tmp_path / "twice.csv").write_text("entity_id,entity_id\nE1,E2\n")
    with pytest.raises(ValueError, match="twice"):
        raw.scan_csv(spark, str(tmp_path / "twice.csv"), "entities")


def test_parquet_rows_have_places(spark, tmp_path):
    import pyarrow.parquet as pq

    spark.range(1000).select(F.col("id").cast("string").alias("v")).repartition(3).write.parquet(str(tmp_path / "t"))
    got = {(r.source_file.rsplit("/", 1)[1], r.row_index): r.v for r in raw.physical_rows(spark.read.parquet(str(tmp_path / "t"))).collect()}
    want = {(f.name, i): v for f in (tmp_path / "t").glob("*.parquet") for i, v in enumerate(pq.read_table(f)["v"].to_pylist())}
    assert got == want and len(got) == 1000


# publication

def test_published_run_is_whole(spark, tmp_path):
    root = str(tmp_path)
    assert publish.current(spark, root) is None
    with pytest.raises(ValueError):
        publish.read(spark, root, "t")
    for run, values in (("r1", [1, 2]), ("2024-01-31T00:00:00", [3])):
        folder = publish.begin(spark, root, run)
        spark.createDataFrame([(v,) for v in values], "v int").write.parquet(f"{folder}/t")
        if run != "r1":  # not yet published: readers see the run before
            assert sorted(r.v for r in publish.read(spark, root, "t").collect()) == [1, 2]
        publish.publish(spark, root, run)
        assert sorted(r.v for r in publish.read(spark, root, "t").collect()) == values
    with pytest.raises(ValueError, match="published"):
        publish.begin(spark, root, "2024-01-31T00:00:00")
    with pytest.raises(ValueError):
        publish.publish(spark, root, "unknown")
    with pytest.raises(ValueError):
        publish.run_folder(root, "../other")
    assert [p.name for p in tmp_path.iterdir() if "CURRENT-" in p.name] == []


def test_months_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "m")
    rows = [(date(2024, m, 1), m) for m in (1, 2, 3)]
    for _ in range(2):
        publish.replace_months(spark.createDataFrame(rows, "period date, v int"), path)
    publish.replace_months(spark.createDataFrame([(date(2024, 2, 1), 20), (date(2024, 2, 1), 21)], "period date, v int"), path)
    assert sorted((r.month, r.v) for r in spark.read.parquet(path).collect()) == [("2024-01", 1), ("2024-02", 20), ("2024-02", 21), ("2024-03", 3)]


# from raw tables to books

COA = [("1000", "Cash", "Asset", "Cash", "Debit"), ("1001", "Accounts Receivable", "Asset", "Accounts Receivable", "Debit"),
       ("2000", "Accounts Payable", "Liability", "Accounts Payable", "Credit"), ("2003", "Long-term Debt", "Liability", "Debt", "Credit"),
       ("3000", "Common Stock", "Equity", "Common Stock", "Credit"), ("4000", "Sales", "Revenue", "Product Revenue", "Credit"),
       ("5000", "Cost of Goods Sold", "COGS", "COGS", "Debit"), ("6020", "Utilities", "Operating Expense", "Utilities", "Debit")]


@pytest.fixture(scope="module")
def raw_books(spark):
    months = [date(2022 + i // 12, i % 12 + 1, 15) for i in range(24)]
    events = [event(f"OPEN_{e}", "Opening Balance", months[0].replace(day=1), "1000", "3000", 900_000, entity=e) for e in "AB"]
    events += [event("OPEN_D", "Opening Balance", months[0].replace(day=1), "1000", "2003", 100_000, entity="A")]
    for e in "AB":
        for i, day in enumerate(months):
            key, sales = f"{e}{i}", 20_000 + 500 * (i % 12) + 13 * i
            events += [event(f"S{key}", "Revenue Invoice", day, "1001", "4000", sales, entity=e),
                       event(f"R{key}", "Cash Receipt", day.replace(day=28), "1000", "1001", sales * 0.9, entity=e),
                       event(f"V{key}", "Vendor Invoice", day, "5000", "2000", 9000 + 70 * (i % 5), entity=e),
                       event(f"P{key}", "Vendor Payment", day.replace(day=27), "2000", "1000", 8000, entity=e),
                       event(f"U{key}", "Vendor Invoice", day.replace(day=3), "6020", "2000", 1500 + 10 * (i % 4), entity=e)]
    coa = spark.createDataFrame(COA, "account_id string, account_name string, account_category string, account_subcategory string, normal_balance string")
    legs = journal.post_journal(spark.createDataFrame(events, EVENT_SCHEMA), coa)
    legs = legs.withColumns({"counterparty_id": F.lit("C1"), "payment_date": F.col("transaction_date"), "payment_due_date": F.col("transaction_date")})
    frames = {"transactions": legs.select(*EXPECTED_COLUMNS["transactions"]), "chart_of_accounts": coa}
    frames["entities"] = spark.createDataFrame([("A", "A", "DE", "EUR"), ("B", "B", "DE", "EUR")], list(EXPECTED_COLUMNS["entities"]))
    frames["fx_rates"] = spark.createDataFrame([(d.replace(day=1), "EUR", Decimal("1.0")) for d in months], list(EXPECTED_COLUMNS["fx_rates"]))
    frames["customers"] = spark.createDataFrame([("C1", "C", "A", "EUR", "S")], list(EXPECTED_COLUMNS["customers"]))
    frames["vendors"] = spark.createDataFrame([("V1", "V", "A", "EUR", "30")], list(EXPECTED_COLUMNS["vendors"]))
    frames["accounts_receivable"] = spark.createDataFrame(
        [("I1", "C1", "A", "2022-01-15", "2022-02-15", "2022-02-01", "EUR", "10", "Paid", "BU", "S")], list(EXPECTED_COLUMNS["accounts_receivable"]))
    frames["accounts_payable"] = spark.createDataFrame(
        [("I2", "V1", "A", "2022-01-15", "2022-02-15", "2022-02-01", "EUR", "12", "2", "10", "Paid", "BU", "X")], list(EXPECTED_COLUMNS["accounts_payable"]))
    return {n: raw.with_row_uid(raw.as_raw(df), n) for n, df in frames.items()}


SETTINGS = books.BookSettings(simulation=SimulationSettings(n_simulations=40), models={"naive": forecasting.naive, "seasonal_naive": forecasting.seasonal_naive})


def test_books_end_to_end(spark, raw_books, tmp_path, monkeypatch):
    root = str(tmp_path / "books")

    def fails(tables, folder, *_):
        tables["entities"].write.parquet(f"{folder}/issues/checks")
        raise RuntimeError("lost in between")

    with monkeypatch.context() as patch:
        patch.setattr(books, "run_quality_engine", fails)
        with pytest.raises(RuntimeError, match="lost"):
            books.publish_books(raw_books, root, "january", "2024-01-31T00:00:00+00:00", SETTINGS)
    assert publish.current(spark, root) is None
    folder = books.publish_books(raw_books, root, "january", "2024-01-31T00:00:00+00:00", SETTINGS)
    assert publish.current(spark, root) == folder
    income = publish.read(spark, root, "income_statement")
    assert income.count() == 48 and {r.status for r in publish.read(spark, root, "balance_sheet").collect()} == {"PASS"}
    before_accruals = publish.read(spark, root, "accruals").count()
    assert publish.read(spark, root, "accruals").select("month").distinct().count() == 22
    forecasts = publish.read(spark, root, "forecasts")
    assert forecasts.count() == 2 * len(forecasting.METRICS) * 12
    reports = {}
    for name in ("quality", "liquidity", "cash_plan"):
        lines = [json.loads(line) for f in (tmp_path / "books" / "runs" / "january" / "reports" / name).glob("*.json") for line in f.read_text().splitlines()]
        reports[name] = lines
    layer = reports["quality"][0]
    assert layer["row_counts_raw"]["transactions"] == raw_books["transactions"].count() == layer["row_counts_validated"]["transactions"] + layer["row_counts_quarantined"]["transactions"]
    assert len(reports["liquidity"]) == 4 and all(len(r["by_month"]) == 12 for r in reports["liquidity"])
    assert {r["scenario"] for r in reports["cash_plan"]} == {r["scenario"] for r in reports["liquidity"]}
    for r in reports["cash_plan"]:
        assert r["status"] in ("optimal", "infeasible") and ("months" in r) == (r["status"] == "optimal")
    # Written again, the books are the same.
    before = sorted(map(str, income.collect()))
    assert sorted(map(str, books.write_statements(spark, folder)["income_statement"].collect())) == before
    assert publish.read(spark, root, "accruals").count() == before_accruals


def test_infeasible_plans_have_a_status(spark):
    from tests.test_finance import floors_of

    floors = floors_of(spark, [10, 15]).unionByName(floors_of(spark, [1e9, 1e9]).withColumn("scenario", F.lit("t")))
    rows = cash_plan.search_plan(floors)
    status = {r.scenario: r.status for r in cash_plan.plan_status(floors, rows).collect()}
    solved = {r.scenario for r in rows.select("scenario").distinct().collect()}
    assert status == {s: "optimal" if s in solved else "infeasible" for s in status} and set(status.values()) == {"optimal", "infeasible"}
