from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tallystone.config import QualitySettings
from tallystone.functions import ranks
from tallystone.functions.parsing import to_date
from tallystone.operators import completeness, consistency, reconciliation, scoring, uniqueness, validity
from tallystone.operators.issues import evaluate_row_rules, rule_dimension
from tallystone.schema import EXPECTED_COLUMNS, PAYABLES, RECEIVABLES, TRANSACTIONS
from tallystone.sources import layers, raw

S = QualitySettings()


def uids(df):
    return sorted(r.row_uid for r in df.select("row_uid").collect())


def run(df, dataset, *rules):
    return evaluate_row_rules(df, dataset, list(rules))


def test_missing_id_is_critical(spark):
    columns = "row_uid, transaction_id, entity_id, account_id, amount, currency, business_unit, account_name, counterparty_id, document_type, payment_date"
    rows = [("T1", None, "E", "1", "5", "EUR", "B", "A", "C", "Payroll", None),
            ("T2", "x", "E", "1", "5", "EUR", "B", "A", "C", "Payroll", None)]
    df = spark.createDataFrame(rows, ", ".join(c.strip() + " string" for c in columns.split(",")))
    out = evaluate_row_rules(df, TRANSACTIONS, completeness.completeness_rules(df, TRANSACTIONS, S)).collect()
    assert [(r.row_uid, r.validation_rule, r.severity) for r in out] == [("T1", "missing_transaction_id", "CRITICAL")]


@pytest.mark.parametrize("status,rule,severity", [
    ("Open", "missing_payment_date_unpaid", "LOW"), (None, "missing_payment_date_unpaid", "LOW"),
    ("Paid", "missing_payment_date_inconsistent", "HIGH"),
])
def test_payment_date_context(spark, status, rule, severity):
    df = spark.createDataFrame([("R1", status, " ")], "row_uid string, payment_status string, payment_date string")
    out = run(df, RECEIVABLES, *completeness.invoice_payment_date_rules(S)).collect()
    assert [(r.validation_rule, r.severity) for r in out] == [(rule, severity)]


def test_ledger_payment_reason_names_document(spark):
    df = spark.createDataFrame([("R1", "Cash Receipt", None)], "row_uid string, document_type string, payment_date string")
    out = run(df, TRANSACTIONS, *completeness.ledger_payment_date_rules(S)).first()
    assert out.reason == "payment booked as Cash Receipt without a payment date"


def test_exact_duplicates_flag_every_copy(spark):
    df = raw.with_row_uid(spark.createDataFrame([("1", "x"), ("1", "x"), ("2", "y")], "a string, b string"), "t")
    assert len(uids(uniqueness.exact_duplicates(df, "t", "HIGH"))) == 2


def test_copies_are_numbered_uniquely(spark, monkeypatch):
    monkeypatch.setattr(raw, "COPIES_PER_CHUNK", 3)
    df = raw.with_row_uid(spark.createDataFrame([("1", None)] * 10 + [("2", "y")], "a string, b string"), "t")
    numbered = raw.number_copies(df)
    assert numbered.count() == 11 and numbered.select("row_uid").distinct().count() == 11


def test_null_and_text_have_other_digests(spark):
    df = raw.with_row_uid(spark.createDataFrame([(None, "a"), ("", "a"), ("a", None)], "a string, b string"), "t")
    assert len(set(uids(df))) == 3


def test_duplicate_invoice(spark):
    df = spark.createDataFrame([("R1", "I1"), ("R2", "I1"), ("R3", "I2"), ("R4", None), ("R5", None)], "row_uid string, invoice_id string")
    assert uids(uniqueness.duplicate_invoice_ids(df, RECEIVABLES, "HIGH")) == ["R1", "R2"]


def test_business_key_needs_all_parts(spark):
    df = spark.createDataFrame([("R1", "p", "d"), ("R2", "p", "d"), ("R3", "p", None), ("R4", "p", None)], "row_uid string, a string, b string")
    assert uids(uniqueness.business_key_duplicates(df, "t", ["a", "b"], "HIGH")) == ["R1", "R2"]
    assert uniqueness.business_key_duplicates(df, "t", ["a", "zz"], "HIGH") is None


def brute_near(rows, tol=0.005):
    from decimal import Decimal

    flagged = set()
    for i, (uid, inv, party, amount, day) in enumerate(rows):
        for j, (_, inv2, party2, amount2, day2) in enumerate(rows):
            if i == j or None in (party, amount, day) or (party, day) != (party2, day2) or amount2 is None:
                continue
            other = inv is None or inv2 is None or inv != inv2
            if other and abs(Decimal(amount2) - Decimal(amount)) <= Decimal(amount) * Decimal(str(tol)):
                flagged.add(uid)
    return sorted(flagged)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_near_duplicates_match_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(400):
        amount = rng.choice([0, -5, 100, 100.5, 100.51, 99.5, 1000, 1004.99, 1005, 1005.01, rng.uniform(1, 2000)])
        rows.append((
            f"R{i}", rng.choice([None, "A", "B", "C", f"I{i}"]), rng.choice(["p", "q", None]), f"{amount:.2f}",
            rng.choice(["2024-01-01", "2024-01-02", "2024-02-30"]),
        ))
    rows = [(u, i, p, a, d) for u, i, p, a, d in rows]
    df = spark.createDataFrame(rows, "row_uid string, invoice_id string, party string, amount string, day string")
    got = uids(uniqueness.near_duplicates(df, RECEIVABLES, "party", "amount", "day", "MEDIUM"))
    assert got == brute_near([(u, i, p, a, None if d == "2024-02-30" else d) for u, i, p, a, d in rows])


def test_value_rules(spark):
    df = spark.createDataFrame(
        [("R1", "XYZ", "-5", "2024-02-30"), ("R2", "EUR", "5", "2024-2-3"), ("R3", None, "abc", "2024-02"), ("R4", "USD", None, " ")],
        "row_uid string, currency string, amount string, day string",
    )
    assert uids(run(df, "t", validity.currency_rule("HIGH"))) == ["R1"]
    assert uids(run(df, "t", validity.negative_amount_rule("amount", "MEDIUM"))) == ["R1"]
    assert uids(run(df, "t", *validity.invalid_date_rules(df, ("day", "none"), "HIGH"))) == ["R1", "R3"]


def test_strict_dates(spark):
    values = ["2024-02-30", "2024-13-05", "2024-02", "20240203", " 2024-02-03", "2024-02-03 10:00", "2024-2-3", "2024-02-03"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert [r.v for r in df.where(to_date(F.col("v")).isNotNull()).collect()] == ["2024-2-3", "2024-02-03"]


def test_date_order_and_gross(spark):
    df = spark.createDataFrame([("R1", "2024-02-15", "2024-02-10"), ("R2", "2024-02-15", "2024-02-15")], "row_uid string, a string, b string")
    assert uids(run(df, "t", validity.date_order_rule("a", "b", "r", "HIGH", "x"))) == ["R1"]
    ap = spark.createDataFrame([("R1", "119", "100", "19"), ("R2", "119", "100", "10"), ("R3", "119.01", "100", "19"), ("R4", None, "1", "1")],
                               "row_uid string, invoice_amount string, net_amount string, tax_amount string")
    assert uids(run(ap, PAYABLES, validity.gross_rule("0.01", "MEDIUM"))) == ["R2"]


def test_grouped_median_matches_percentile(spark):
    rng = random.Random(7)
    rows = [(g, round(rng.gauss(0, 10 ** rng.randint(0, 6)), 2)) for g in "abc" for _ in range(501 if g == "a" else 200)]
    df = spark.createDataFrame(rows, "g string, v double").withColumn("v", F.col("v").cast("decimal(18,2)"))
    got = {r.g: float(r["median"]) for r in ranks.grouped_median(df, ["g"], "v").collect()}
    want = {r.g: r.m for r in df.groupBy("g").agg(F.percentile("v", F.lit(0.5)).alias("m")).collect()}
    assert got == pytest.approx(want)


def test_outliers_need_rows_and_spread(spark):
    rows = [(f"A{i}", "a", str(100 + i % 5)) for i in range(30)] + [("OUT", "a", "10000")]
    rows += [(f"B{i}", "b", "7") for i in range(30)] + [("FLAT", "b", "10000")]
    rows += [(f"C{i}", "c", str(i)) for i in range(10)] + [("FEW", "c", "10000"), ("N", None, "99999")]
    df = spark.createDataFrame(rows, "row_uid string, g string, amount string")
    out = validity.outliers(validity.outlier_values(df, TRANSACTIONS, "amount", "g"), S)
    assert uids(out) == ["OUT"]


def test_foreign_keys_and_drift(spark):
    df = spark.createDataFrame([("R1", "9999", "x"), ("R2", "4000", "Revenue"), ("R3", None, "x"), ("R4", "4000", "Operating Expense")],
                               "row_uid string, account_id string, account_category string")
    coa = spark.createDataFrame([("4000", "Revenue")], "account_id string, account_category string")
    out = consistency.references(df, TRANSACTIONS, {"account_id": (consistency.known_accounts(coa), "HIGH")}, "HIGH")
    assert uids(out.where("validation_rule = 'invalid_account_id'")) == ["R1"]
    assert uids(out.where("validation_rule = 'inconsistent_classification'")) == ["R4"] and out.count() == 2


def _keyed_if(failing: str):
    """A lineage key that is an error for records that fail nothing."""
    return F.expr(f"CASE WHEN {failing} THEN concat('R', row_no) ELSE raise_error('key of a clean record') END").alias("row_uid")


def test_row_rules_make_no_key_of_a_clean_record(spark):
    rows = spark.createDataFrame([("1", "EUR"), ("2", "XYZ"), ("3", None), ("4", "USD")], "row_no string, currency string")
    df = rows.select(_keyed_if("currency = 'XYZ'"), "currency")
    assert uids(evaluate_row_rules(df, TRANSACTIONS, [validity.currency_rule("HIGH")])) == ["R2"]


def test_references_make_no_key_of_a_clean_record(spark):
    schema = "row_no string, account_id string, account_category string, entity_id string"
    rows = [("1", "4000", "Revenue", "ASIA"), ("2", "9999", "x", "ASIA"), ("3", None, "x", None), ("4", "4000", "COGS", "ASIA"),
            ("5", "4000", "Revenue", "ATLANTIS"), ("6", "4000", None, "ASIA"), ("7", "5000", "A", "ASIA")]
    df = spark.createDataFrame(rows, schema).select(_keyed_if("row_no IN ('2', '4', '5', '7')"), "account_id", "account_category", "entity_id")
    coa = spark.createDataFrame([("4000", "Revenue"), ("5000", "A"), ("5000", "B")], "account_id string, account_category string")
    entities = consistency._known_keys(spark.createDataFrame([("ASIA",), ("ASIA",), (None,)], "entity_id string"), "entity_id")
    masters = {"account_id": (consistency.known_accounts(coa), "HIGH"), "entity_id": (entities, "HIGH")}
    out = consistency.references(df, TRANSACTIONS, masters, "HIGH")
    assert sorted((r.row_uid, r.validation_rule) for r in out.collect()) == [
        ("R2", "invalid_account_id"), ("R4", "inconsistent_classification"), ("R5", "invalid_entity_id"), ("R7", "inconsistent_classification"),
    ]


def test_outliers_make_no_key_of_a_clean_record(spark):
    rows = [(str(i), "a", str(100 + i % 5)) for i in range(30)] + [("98", "a", "10000"), ("99", "a", "10000"), ("97", None, "5"), ("96", "a", "x")]
    df = spark.createDataFrame(rows, "row_no string, g string, amount string").select(_keyed_if("amount = '10000'"), "g", "amount")
    assert sorted(uids(validity.outliers(validity.outlier_values(df, TRANSACTIONS, "amount", "g"), S))) == ["R98", "R99"]


def test_journal_balance_flags_all_legs(spark):
    df = spark.createDataFrame(
        [("R1", "D1", "100", "0"), ("R2", "D1", "0", "90"), ("R3", "D2", "50", "x"), ("R4", "D2", None, "50"), ("R5", None, "5", "0")],
        "row_uid string, document_id string, debit string, credit string",
    )
    assert uids(reconciliation.journal_balance_issues(df, "0.01", "CRITICAL")) == ["R1", "R2"]


def test_tie_out_reports_missing_sides(spark):
    sub = spark.createDataFrame([("E", "2024-01-05", "100"), ("F", "2024-02-05", "10")], "entity_id string, invoice_date string, invoice_amount string")
    gl = spark.createDataFrame(
        [("E", "2024-01-09", "Revenue Invoice", "Accounts Receivable", "100"), ("E", "2024-03-09", "Revenue Invoice", "Accounts Receivable", "7")],
        "entity_id string, transaction_date string, document_type string, account_name string, debit string",
    )
    out = reconciliation.tie_out_issues(sub, gl, RECEIVABLES, "invoice_amount", "Revenue Invoice", "Accounts Receivable", "debit", "0.01", "HIGH")
    assert sorted(r.reason for r in out.collect()) == [
        "accounts_receivable of E in 2024-03: sub-ledger 0.00, Accounts Receivable postings 7.00, off by 7.00",
        "accounts_receivable of F in 2024-02: sub-ledger 10.00, Accounts Receivable postings 0.00, off by 10.00",
    ]


ISSUE = "row_uid string, dataset string, validation_rule string, severity string, reason string, field string, dimension string"


def test_cascade_quarantines_the_document(spark):
    legs = spark.createDataFrame([("T1", "D1"), ("T2", "D1"), ("T3", "D2"), ("T4", "D2"), ("T5", None)], "row_uid string, document_id string")
    issues = spark.createDataFrame([("T1", TRANSACTIONS, "missing_amount", "CRITICAL", "r", None, "completeness"),
                                    ("T3", TRANSACTIONS, "duplicate_near", "MEDIUM", "r", None, "uniqueness")], ISSUE)
    full = scoring.with_cascade(legs, issues)
    assert uids(scoring.cascade_issues(legs, issues)) == ["T2"]
    assert uids(scoring.validated_rows(legs, full)) == ["T3", "T4", "T5"]
    assert uids(scoring.quarantined_rows(legs, full)) == ["T1", "T2"]
    ledger = scoring.quarantine_ledger(full, "now").collect()
    assert sorted(r.record_id for r in ledger) == ["T1", "T2"] and {r.timestamp for r in ledger} == {"now"}


def test_score_and_counts(spark):
    table = spark.createDataFrame([(f"R{i}",) for i in range(10)], "row_uid string")
    tables = {n: table for n in (TRANSACTIONS, RECEIVABLES, PAYABLES)}
    issues = spark.createDataFrame([("R1", TRANSACTIONS, "missing_amount", "CRITICAL", "r", None, "completeness"),
                                    ("R1", TRANSACTIONS, "invalid_date", "odd", "r", None, "validity"),
                                    (None, TRANSACTIONS, "schema_missing_column", "CRITICAL", "r", None, None)], ISSUE)
    row = scoring.quality_score(issues, tables).first()
    assert (row.completeness_score, row.validity_score, row.uniqueness_score) == (96.67, 99.0, 100.0)
    assert row.overall_score == pytest.approx(99.13) and row.total_rows == 30
    counts = {(r.grouping, r.name): r.n_issues for r in scoring.issue_counts(issues).collect()}
    assert counts[("severity", "CRITICAL")] == 2 and counts[("rule", "invalid_date")] == 1
    layer = {r.dataset: (r.n_raw, r.n_validated, r.n_quarantined) for r in scoring.layer_counts(tables, issues).collect()}
    assert layer[TRANSACTIONS] == (10, 9, 1)


def test_rule_dimensions(spark):
    rules = ["missing_x", "duplicate_exact", "invalid_due_date", "invalid_account_id", "invalid_vendor_id", "journal_entry_unbalanced", "schema_missing_column"]
    df = spark.createDataFrame([(r,) for r in rules], "r string").select(rule_dimension(F.col("r")).alias("d"))
    assert [r.d for r in df.collect()] == ["completeness", "uniqueness", "validity", "consistency", "consistency", "reconciliation", None]


def test_csv_scan_normalises_missing_values(spark, tmp_path):
    path = tmp_path / "entities.csv"
    path.write_text("entity_id,entity_name,country\nE1,N/A,DE\nE2,,null\n")
    df = raw.read_raw_csv(spark, str(path), "entities")
    assert [tuple(r)[1:] for r in df.orderBy("entity_id").collect()] == [("E1", None, "DE"), ("E2", None, None)]
    assert [r.field for r in completeness.schema_issues(df, "entities").collect()] == ["functional_currency"]
    with pytest.raises(ValueError):
        raw.read_raw_csv(spark, str(path), "unknown")


def test_layers_round_trip(spark, tmp_path):
    row = ["x"] * len(EXPECTED_COLUMNS[RECEIVABLES])
    df = spark.createDataFrame([row], list(EXPECTED_COLUMNS[RECEIVABLES])).withColumns(
        {"invoice_date": F.lit("2024-02-03"), "invoice_amount": F.lit("12.5")})
    layers.write_validated({RECEIVABLES: df}, str(tmp_path))
    back = layers.read_validated(spark, str(tmp_path), RECEIVABLES).first()
    assert str(back.invoice_date) == "2024-02-03" and str(back.invoice_amount) == "12.50" and back.due_date is None
    layers.write_table(layers.read_validated(spark, str(tmp_path), RECEIVABLES), str(tmp_path / "csv"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first().invoice_date == "2024-02-03"


HEAD = "entity_id,entity_name,country,functional_currency,annual_revenue_scale_eur\n"


def test_csv_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "entities.csv").write_text(HEAD + 'E1,"Two\nlines, ""quoted""",DE,EUR,5\nE2,Back\\slash,FR,EUR,n/a\n')
    rows = {r.entity_id: r for r in raw.read_raw_csv(spark, str(tmp_path / "entities.csv"), "entities").collect()}
    assert rows["E1"].entity_name == 'Two\nlines, "quoted"' and rows["E2"].entity_name == "Back\\slash"
    assert rows["E2"].annual_revenue_scale_eur is None and len(rows) == 2


def test_csv_files_with_other_headers_are_an_error(spark, tmp_path):
    folder = tmp_path / "entities.csv"
    folder.mkdir()
    (folder / "a.csv").write_text(HEAD + "E1,One,DE,EUR,5\n")
    (folder / "b.csv").write_text("country,entity_name,entity_id,functional_currency,annual_revenue_scale_eur\nFR,Two,E2,EUR,6\n")
    with pytest.raises(Exception, match="(?i)header"):
        raw.read_raw_csv(spark, str(folder), "entities").collect()


def test_quality_engine_end_to_end(spark, tmp_path):
    """CSV files of all eight tables in, layers, ledger and report out."""
    from tallystone.plans.quality import run_quality_engine

    for name, columns in EXPECTED_COLUMNS.items():
        rows = [",".join(f"v{i}" for i, _ in enumerate(columns))]
        (tmp_path / f"{name}.csv").write_text("\n".join([",".join(columns), *rows]) + "\n")
    tables = raw.read_all_raw(spark, str(tmp_path))
    report = run_quality_engine(tables, str(tmp_path / "out"), run_timestamp="2024-01-31T00:00:00+00:00")
    assert report.count() == 1 and any((tmp_path / "out").iterdir())


def test_off_one_machine_a_shared_folder_is_needed(spark, monkeypatch):
    from types import SimpleNamespace

    from tallystone import session

    remote = SimpleNamespace(
        sparkContext=SimpleNamespace(master="spark://somewhere:7077", getCheckpointDir=lambda: None),
        conf=SimpleNamespace(get=lambda *_: None),
    )
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(remote)


def test_quarantine_detail_covers_all_tables(spark):
    from tallystone.operators import scoring
    from tallystone.schema import ROW_LEVEL_DATASETS

    tables = {n: spark.createDataFrame([(f"{n}1", "e1", f"v{n}")], f"row_uid string, entity_id string, own_{n} string") for n in ROW_LEVEL_DATASETS}
    entries = [(n, f"{n}1", "rule", "HIGH", "why", "now") for n in ROW_LEVEL_DATASETS]
    ledger = spark.createDataFrame(
        entries, "dataset string, record_id string, validation_rule string, severity string, reason string, timestamp string"
    )
    got = scoring.quarantine_detail_of_tables(ledger, tables).collect()
    assert sorted(r.dataset for r in got) == sorted(ROW_LEVEL_DATASETS)
    for r in got:
        assert r.entity_id == "e1" and [r[f"own_{n}"] for n in ROW_LEVEL_DATASETS] == [f"v{n}" if n == r.dataset else None for n in ROW_LEVEL_DATASETS]
    assert len(scoring.browse_quarantine(scoring.quarantine_detail_of_tables(ledger, tables), severities=["HIGH"]).collect()) == len(got)


SHARES = [0.0, 0.05, 0.1, 0.25, 0.5, 0.9, 1.0]


@pytest.mark.parametrize("margin", [None, 0.0])
def test_ranks_match_percentiles(spark, monkeypatch, margin):
    """Groups of one value, of few values, with many ties, spread over many powers of ten, of many rows, of null keys. Brackets without
    margin miss ranks, which are then searched in wider ones."""
    if margin is not None:
        monkeypatch.setattr(ranks, "MARGIN", margin)
        monkeypatch.setattr(ranks, "SKETCH_SIZE", 8)
    rng = random.Random(9)
    groups = {
        "one": [3.0], "two": [1.0, -1.0], "ties": [5.0] * 400 + [rng.random() for _ in range(100)], "same": [7.0] * 300,
        "wide": [rng.choice([-1, 1]) * 10 ** rng.uniform(-6, 9) for _ in range(3000)], "many": [rng.gauss(0, 1) for _ in range(20_000)], None: [1.0, 2.0, 4.0],
    }
    rows = [(g, 1, v) for g, values in groups.items() for v in values] + [("one", 1, None), ("empty", 1, None)]
    df = spark.createDataFrame(rows, "g string, h int, v double").repartition(5)
    got = ranks.grouped_ranks(df, ["g", "h"], "v", SHARES).select("g", "n", *[ranks.interpolated(s, i).alias(f"p{i}") for i, s in enumerate(SHARES)])
    want = df.where("v IS NOT NULL").groupBy("g").agg(F.count("v").alias("n"), F.percentile("v", F.array(*map(F.lit, SHARES))).alias("p"))
    expected = {r.g: (r.n, r.p) for r in want.collect()}
    found = {r.g: (r.n, [r[f"p{i}"] for i in range(len(SHARES))]) for r in got.collect()}
    assert found.keys() == expected.keys() == groups.keys()
    for g, (n, p) in expected.items():
        assert found[g][0] == n and found[g][1] == pytest.approx(p, rel=1e-12, abs=1e-12)


def test_ranks_do_not_shuffle_values(spark):
    df = spark.range(50_000).select((F.col("id") % 3).alias("g"), F.sin("id").alias("v"))
    brackets = ranks._brackets(df, ["g"], "v", [0.5], ranks.MARGIN)
    counts = ranks._counted(df, brackets, ["g"], "v", 1)
    assert counts.count() < 3000


def _ledger(spark, rows):
    return raw.with_row_uid(spark.createDataFrame(rows, "document_id string, debit string, credit string, note string"), TRANSACTIONS)


def _exchanges_of(df, spark):
    """The exchanges of a plan, without adaptive execution, with what they deal out."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    try:
        text = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.requireAllClusterKeysForCoPartition"):
            spark.conf.unset(c)
    return text


def _under_exchange(plan, relation):
    """Whether a scan of the relation stands below an exchange."""
    depth_of_exchange = None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :|+-*()0123456789"))
        if depth_of_exchange is not None and depth <= depth_of_exchange:
            depth_of_exchange = None
        if "Exchange " in line and depth_of_exchange is None:
            depth_of_exchange = depth
        if relation in line and "FileScan" in line and depth_of_exchange is not None:
            return True
    return False


def test_ledger_stored_by_document(spark, tmp_path):
    rng = random.Random(1)
    rows = [(rng.choice([None, *[f"D{i}" for i in range(40)]]), str(rng.randint(0, 3)), str(rng.randint(0, 3)), str(i % 90)) for i in range(300)]
    plain = _ledger(spark, [*rows, rows[5], rows[5]])
    stored = layers.store_by_document(plain, str(tmp_path / "ledger"), 8)
    name = stored._jdf.queryExecution().analyzed().toString().split("spark_catalog.default.")[1].split("[")[0].split(",")[0].strip()
    assert sorted(stored.select(*plain.columns).collect()) == sorted(plain.collect())
    assert all(r.n == 1 for r in stored.where("document_id IS NOT NULL").groupBy("document_id").agg(F.count_distinct("document_tag").alias("n")).collect())
    issues = reconciliation.journal_balance_issues(plain, "0.01", "CRITICAL").withColumn("dimension", F.lit("reconciliation"))
    assert uids(reconciliation.journal_balance_issues(stored, "0.01", "CRITICAL")) == uids(issues) != []
    some = issues.where(F.crc32(F.col("row_uid").cast("binary")) % 3 == 0)
    assert uids(scoring.cascade_issues(stored, some)) == uids(scoring.cascade_issues(plain, some)) != []
    # Neither rule deals the ledger out again.
    some.write.parquet(str(tmp_path / "some"))
    few = spark.read.parquet(str(tmp_path / "some"))
    for job in (lambda: reconciliation.journal_balance_issues(stored, "0.01", "CRITICAL"), lambda: scoring.cascade_issues(stored, few)):
        assert not _under_exchange(_exchanges_of(job(), spark), name)


def test_layers_in_one_pass(spark, tmp_path):
    row = {n: spark.createDataFrame([[f"{c}{i}" for c in EXPECTED_COLUMNS[n]] for i in range(6)], list(EXPECTED_COLUMNS[n])) for n in (TRANSACTIONS, RECEIVABLES, PAYABLES)}
    tables = {n: raw.with_row_uid(df.withColumn("currency", F.lit("EUR")), n) for n, df in row.items()}
    tables[TRANSACTIONS] = layers.store_by_document(tables[TRANSACTIONS], str(tmp_path / "ledger"), 4)
    bad = tables[RECEIVABLES].where("invoice_id = 'invoice_id2'").unionByName(tables[TRANSACTIONS].where("document_id = 'document_id1'"), allowMissingColumns=True)
    issues = bad.select("row_uid", F.when(F.col("row_uid").startswith("ACC"), RECEIVABLES).otherwise(TRANSACTIONS).alias("dataset"),
                        *[F.lit(v).alias(c) for c, v in (("validation_rule", "missing_amount"), ("severity", "HIGH"), ("reason", "r"), ("field", "f"), ("dimension", "completeness"))])
    counts = layers.write_layers(tables, scoring.flagged_by_dataset(issues), str(tmp_path / "layers"))
    want = {r.dataset: {k: r[k] for k in ("n_raw", "n_validated", "n_quarantined")} for r in scoring.layer_counts(tables, issues).collect()}
    assert counts == want and want[PAYABLES]["n_quarantined"] == 0 and want[RECEIVABLES]["n_quarantined"] == 1
    held = layers.read_layer(spark, str(tmp_path / "layers"), RECEIVABLES, "quarantined").collect()
    assert [r.invoice_id for r in held] == ["invoice_id2"] and "invoice_date2" in held[0].raw_record and held[0].invoice_date is None
    assert layers.read_layer(spark, str(tmp_path / "layers"), TRANSACTIONS).where("raw_record IS NULL").count() == 5
    split = {(r.dataset, r.layer): r.n for r in scoring.split_layers(tables, issues).groupBy("dataset", "layer").agg(F.count("*").alias("n")).collect()}
    assert split[RECEIVABLES, "quarantined"] == 1 and split[TRANSACTIONS, "validated"] == 5


def test_rule_counts_are_those_of_the_issues(spark):
    df = spark.createDataFrame([("R1", "XYZ", "-5", None), ("R2", "EUR", "5", None), ("R3", None, "abc", "2024-01-01"), ("R4", "XYZ", "-1", " ")],
                               "row_uid string, currency string, amount string, payment_date string").withColumn("document_type", F.lit("Cash Receipt"))
    rules = [validity.currency_rule("HIGH"), validity.negative_amount_rule("amount", "MEDIUM"), *completeness.ledger_payment_date_rules(S)]
    from tallystone.operators.issues import rule_counts
    found = evaluate_row_rules(df, "t", rules).groupBy("dataset", "validation_rule", "severity", "field").agg(F.count("*").alias("n_issues"))
    assert sorted(map(tuple, rule_counts(df, "t", rules).select(*found.columns).collect())) == sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("filters", [{}, {"severities": ["HIGH"], "entities": ["e1", "e2"]}, {"sources": ["s1"]}, {"rules": ["r0"], "limit": 3}])
def test_browse_fetches_what_the_detail_shows(spark, filters):
    from tallystone.schema import ROW_LEVEL_DATASETS

    extra = {TRANSACTIONS: "source_system string, account_id string, transaction_date string", RECEIVABLES: "invoice_date string", PAYABLES: "invoice_date string"}
    tables = {}
    for n in ROW_LEVEL_DATASETS:
        width = extra[n].count(",") + 1
        rows = [(f"{n}{i}", f"e{i % 3}", *[f"s{i % 2}"] * width) for i in range(12)]
        tables[n] = spark.createDataFrame(rows + rows[:2], f"row_uid string, entity_id string, {extra[n]}")
    entries = [(n, f"{n}{i}", f"r{k}", ("HIGH", "CRITICAL")[i % 2], "why", "now") for n in ROW_LEVEL_DATASETS for i in range(12) for k in range(1 + i % 2)]
    ledger = spark.createDataFrame(entries, "dataset string, record_id string, validation_rule string, severity string, reason string, timestamp string")
    want = scoring.browse_quarantine(scoring.quarantine_detail_of_tables(ledger, tables), **filters)
    got = scoring.browse_ledger(ledger, tables, **filters)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_few_rows_are_compared_by_whole_keys(spark, tmp_path):
    """Copies and unbalanced documents are told from digests; only suspects meet again by their keys."""
    rows = spark.createDataFrame(
        [(f"u{i}", f"d{i // 2}", "10", "0") if i % 2 else (f"u{i}", f"d{i // 2}", "0", "10") for i in range(200)]
        + [("u7", "d3", "0", "0"), ("u200", "d50", "3", "0"), ("u201", None, "9", "0"), ("u202", "d200", None, "x")],
        "row_uid string, document_id string, debit string, credit string",
    )
    found = uniqueness.exact_duplicates(rows, TRANSACTIONS, "HIGH")
    assert [r.row_uid for r in found.collect()] == ["u7", "u7"]
    open_legs = reconciliation.journal_balance_issues(rows, "0.01", "CRITICAL")
    assert sorted(r.row_uid for r in open_legs.collect()) == ["u100", "u101", "u200"]
    for df in (found, open_legs):
        text = df._jdf.queryExecution().optimizedPlan().toString()
        assert "LogicalRDD" not in text and "LocalRelation" not in text


def _keyless(columns, rows, lone):
    """Rows whose lineage key is an error where the condition holds: nobody may ask for it."""
    def build(spark):
        df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
        own = raw.with_row_uid(df, TRANSACTIONS)
        error = F.raise_error(F.lit("a key was made")).cast("string")
        return own.withColumn("row_uid", F.coalesce(F.when(F.expr(lone), error).otherwise(F.col("row_uid")), F.lit("")))
    return build


def test_exact_copies_get_keys_only_where_ids_repeat(spark):
    rows = [("t1", "d1", "5"), ("t1", "d1", "5"), ("t1", "d1", "6"), ("t2", "d2", "5"), (None, None, "7"), (None, None, "7"), (None, None, "8")]
    df = _keyless(("transaction_id", "document_id", "amount"), rows, "transaction_id = 't2'")(spark)
    found = [r.row_uid for r in uniqueness.exact_duplicates(df, TRANSACTIONS, "HIGH").collect()]
    assert len(found) == 4 and len(set(found)) == 2


def test_layers_of_a_tagged_ledger_get_keys_only_of_flagged_documents(spark):
    """Cascade, counts and the validated layer: the same as without the tag."""
    columns = ("document_id", "amount")
    rows = [("d1", "5"), ("d1", "6"), ("d1", "6"), ("d2", "5"), ("d2", "5"), (None, "7"), (None, "8")]
    plain = raw.with_row_uid(spark.createDataFrame(rows, "document_id string, amount string"), TRANSACTIONS)
    flagged = plain.where("amount = '5' AND document_id = 'd1' OR amount = '7'").select("row_uid")
    issues = flagged.select("row_uid", F.lit(TRANSACTIONS).alias("dataset"), F.lit("r").alias("validation_rule"), F.lit("HIGH").alias("severity"))
    tagged = layers.with_document_tag(_keyless(columns, rows, "document_id = 'd2'")(spark))
    near = scoring.flagged_documents(tagged, issues)
    assert uids(scoring.cascade_issues(near, issues)) == uids(scoring.cascade_issues(plain, issues))
    others = {n: raw.with_row_uid(spark.createDataFrame([("a",)], "x string"), n) for n in (RECEIVABLES, PAYABLES)}
    counts = {r.dataset: (r.n_raw, r.n_validated, r.n_quarantined) for r in scoring.layer_counts({TRANSACTIONS: tagged, **others}, issues).collect()}
    assert counts == {TRANSACTIONS: (7, 5, 2), RECEIVABLES: (1, 1, 0), PAYABLES: (1, 1, 0)}
    kept = lambda df: sorted((r.document_id or "", r.amount) for r in scoring.validated_rows(df, issues).select("document_id", "amount").collect())
    assert kept(tagged) == kept(plain) and len(kept(plain)) == 5
