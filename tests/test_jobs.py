from datetime import date

import pytest

from tallyhouse import jobs
from tallyhouse.plans.pipeline import Warehouse, load_transactions, tagged_transactions
from tallyhouse.schemas import TRANSACTIONS
from tallyhouse.sources.files import read_table
from tallyhouse.sources.jdbc import Split
from tests.conftest import plan_of, rows

FILES = {
    "channels.csv": "channel_id,channel_name\n1,POS\n2,online\n",
    "categories.csv": "category_id,category_name,is_essential\n1,ATM,True\n2,gas,False\n",
    "merchants.csv": "merchant_id,merchant_name,category_id,city_id\nm1,Cash,1,34\nm2,Fuel,2,34\n",
    "transaction_types.csv": "transaction_type_id,transaction_type_name,is_transfer,is_income\n1,payment,False,False\n",
    "transactions.csv": (
        "transaction_id_dd,transaction_date,transaction_time,transaction_date_key,customer_id,account_id,merchant_id,"
        "branch_id,channel_id,transaction_type_id,amount,currency,is_recurring,is_salary,previous_balance,"
        "balance_after_transaction\n"
        "t1,2024-01-05,10:00:00,20240105,c1,a1,m1,b1,1,1,10.50,USD,False,False,100,89.5\n"
        "t2,2024-02-05,10:00:00,20240205,c1,a1,m2,b1,1,1,4.00,USD,False,False,89.5,85.5\n"
        "t3,2024-13-05,10:00:00,20240205,c1,a1,m2,b1,1,1,4.00,USD,False,False,89.5,85.5\n"
    ),
}
CUSTOMER = (
    "customer_id,first_name,last_name,date_of_birth,gender,marital_status,education_level,employment_status,job_title,"
    "housing,monthly_salary_usd,monthly_passive_income_usd,monthly_rent_in_usd,monthly_rent_out_usd,annual_income,"
    "monthly_salary_day,bill_responsible,bills_due_day,is_renter,rent_due_day,credit_score,num_dependents,segment,"
    "has_passive_income,has_real_estate_income\n"
    "c1,Ayşe,Kaya,1990-01-01,F,single,BA,employed,clerk,rent,1000.00,0,0,400,12000,15,True,3.0,True,,700,0,retirees,"
    "False,False\n"
)


@pytest.fixture
def folder(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for name, text in {**FILES, "customers.csv": CUSTOMER}.items():
        (raw / name).write_text(text, encoding="utf-8")
    return raw


def test_files_to_marts(spark, folder, tmp_path, capsys):
    house = str(tmp_path / "house")
    for _ in range(2):
        assert jobs.run(spark, ["load-files", "--folder", str(folder), "--warehouse", house, "--as-of", "2024-03-01"]) == 0
    printed = capsys.readouterr().out
    assert "transactions: 3 lines, 1 malformed" in printed
    assert "not there: accounts, branches, calender, cities" in printed
    assert jobs.run(spark, ["load-calendar", "--start", "2024-01-01", "--end", "2024-12-31", "--warehouse", house]) == 0
    target = str(tmp_path / "mart")
    args = ["build-mart", "--mart", "customer_monthly", "--warehouse", house, "--target", target, "--as-of", "2024-03-01"]
    assert jobs.run(spark, args) == 0
    found = read_table(spark, target).collect()
    assert len(found) == 1
    assert (found[0]["first_name"], float(found[0]["January"]), float(found[0]["February"])) == ("Ayşe", 10.5, 4.0)
    bucketed = ["--bucketed", "--buckets", "4"]
    assert jobs.run(spark, ["bucket-facts", "--mart", "customer_monthly", "--warehouse", house, "--buckets", "4"]) == 0
    assert jobs.run(spark, [*args[:6], str(tmp_path / "from_buckets"), *args[7:], *bucketed]) == 0
    assert rows(read_table(spark, str(tmp_path / "from_buckets"))) == sorted(map(tuple, found), key=repr)
    with pytest.raises(ValueError, match="--bucketed needs"):
        jobs.run(spark, ["build-mart", "--mart", "is_essential_avg_dm", "--warehouse", house, "--target", target, *bucketed])
    for mart in ("count_category_segment", "is_essential_avg_dm"):
        assert jobs.run(spark, ["build-mart", "--mart", mart, "--warehouse", house, "--target", str(tmp_path / mart)]) == 0
    assert read_table(spark, str(tmp_path / "is_essential_avg_dm")).first()["Essential"] == 1
    assert jobs.run(spark, ["audit", "--warehouse", house, "--target", str(tmp_path / "audit")]) == 0
    report = read_table(spark, str(tmp_path / "audit"))
    found = report.where("rule = 'foreign_key' and table_name = 'transactions'")
    assert {r["column_name"]: r["violations"] for r in found.collect()} == {
        "merchant_id": 0, "customer_id": 0, "channel_id": 0, "transaction_type_id": 0, "transaction_date": 0,
        "account_id": None,
    }
    assert report.where("rule = 'primary_key'").count() == 10
    assert {r["table_name"] for r in report.where("not checked").collect()} >= {"accounts", "branches", "cities"}


def test_audit_job_sees_repeated_and_missing_keys(spark, tmp_path):
    house = str(tmp_path / "house")
    for day, lines in (("2024-03-01", "('B1', 'a'), ('B1', 'b'), (null, 'c'), (null, 'd')"), ("2024-03-02", "('B1', 'a'), ('B2', 'b')")):
        source = spark.sql(f"SELECT *, '1' AS city_id, DATE '2020-01-01' AS branch_start_date FROM VALUES {lines} AS t(branch_id, branch_name)")
        source.write.parquet(str(tmp_path / day))
        args = ["load-dimension", "--table", "branches", "--parquet", str(tmp_path / day), "--warehouse", house, "--as-of", day]
        assert jobs.run(spark, args) == 0
    assert jobs.run(spark, ["audit", "--warehouse", house, "--target", str(tmp_path / "audit")]) == 0
    report = read_table(spark, str(tmp_path / "audit")).where("table_name = 'branches'")
    found = {(r["rule"], r["column_name"]): (r["checked"], r["violations"]) for r in report.collect()}
    assert found[("primary_key", "branch_id")] == (True, 2)
    assert found[("foreign_key", "city_id")] == (False, None)


def test_damaged_lines_and_missing_keys_are_kept_apart(spark, folder, tmp_path, capsys):
    house = str(tmp_path / "house")
    (folder / "merchants.csv").write_text("merchant_id,merchant_name,category_id,city_id\nm1,Cash,1,34\nm2,Fuel\n,Nameless,1,34\n,Other,1,34\n")
    (folder / "cities.csv").write_text("city_id,city_name,country,is_capital\n34,Istanbul,TR,False\n6,Ankara,TR,perhaps\n")
    assert jobs.run(spark, ["load-files", "--folder", str(folder), "--warehouse", house, "--as-of", "2024-03-01"]) == 0
    printed = capsys.readouterr().out
    assert "merchants: 4 lines, 1 malformed, 3 rejected" in printed and "cities: 2 lines, 1 malformed, 1 rejected" in printed
    assert rows(read_table(spark, f"{house}/merchants").select("merchant_id")) == [("m1",)]
    assert rows(read_table(spark, f"{house}/cities").select("city_id")) == [("34",)]
    kept = read_table(spark, f"{house}/rejected_merchants")
    assert sorted(r["_corrupt_record"] or r["merchant_name"] for r in kept.collect()) == ["Nameless", "Other", "m2,Fuel"]


def test_mart_from_a_database_needs_a_split_of_the_facts(spark, monkeypatch):
    mart = ["build-mart", "--mart", "customer_monthly", "--jdbc", "BANK", "--target", "t"]
    with pytest.raises(ValueError, match="split-column"):
        jobs.run(spark, mart)
    split = ["--split-column", "transaction_date", "--split-lower", "2023-01-01", "--split-upper", "2027-01-01", "--split-parts", "48"]
    found = jobs.fact_splits(jobs.parser().parse_args([*mart, *split]))
    assert found == {"transactions": Split("transaction_date", "2023-01-01", "2027-01-01", 48)}


def test_lost_values_are_counted_in_the_window(spark, tmp_path):
    columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in TRANSACTIONS.fields if f.name not in ("transaction_date", "amount"))
    path = str(tmp_path / "source")
    spark.sql(f"SELECT d AS transaction_date, a AS amount, {columns} FROM VALUES (DATE '2024-01-05', 'x'), (DATE '2024-01-06', 'y') AS t(d, a)").write.parquet(path)
    day = date(2024, 1, 5)
    done = load_transactions(read_table(spark, path), Warehouse(spark, str(tmp_path / "house")), start=day, end=day)
    assert [tuple(r) for r in done.report.lost_values().collect()] == [("amount", 1)]
    assert "GreaterThanOrEqual(transaction_date,2024-01-05)" in plan_of(tagged_transactions(read_table(spark, path), start=day, end=day))


def test_transactions_by_window_and_list(spark, folder, tmp_path, monkeypatch, capsys):
    house, csv = str(tmp_path / "house"), str(folder / "transactions.csv")
    base = ["load-transactions", "--csv", csv, "--warehouse", house]
    assert jobs.run(spark, [*base, "--start", "2024-01-01", "--end", "2024-01-31"]) == 0
    assert "read 1 rows, stored 1" in capsys.readouterr().out
    monkeypatch.setenv("LOAD_DATES", "2024-02-05, 2024-02-06")
    assert jobs.run(spark, base) == 0
    assert rows(read_table(spark, f"{house}/transactions").select("transaction_id_dd")) == [("t1",), ("t2",)]
    monkeypatch.delenv("LOAD_DATES")
    with pytest.raises(ValueError):
        jobs.run(spark, [*base, "--start", "2024-02-01", "--end", "2024-01-01"])


def test_days_into_the_month_layout(spark, folder, tmp_path, capsys):
    house, target = str(tmp_path / "house"), str(tmp_path / "months")
    jobs.run(spark, ["load-files", "--folder", str(folder), "--warehouse", house])
    for _ in range(2):
        copy = ["copy-months", "--warehouse", house, "--start", "2024-01-01", "--end", "2024-12-31", "--target", target]
        assert jobs.run(spark, copy) == 0
    assert "months: 2024_01, 2024_02" in capsys.readouterr().out
    assert read_table(spark, target).count() == 2


def test_day_by_day_leaves_out_what_the_ledger_has_as_loaded(spark, folder, tmp_path, capsys):
    house, csv = str(tmp_path / "house"), str(folder / "transactions.csv")
    load = ["load-transactions", "--csv", csv, "--warehouse", house, "--day-by-day", "--dates", "2024-01-05,2024-02-05,2024-02-06"]
    for attempt in (1, 2):
        assert jobs.run(spark, load) == 0
        assert f"2024-02-06: empty at attempt {attempt}" in capsys.readouterr().out
    assert rows(read_table(spark, f"{house}/load_ledger").groupBy("outcome").count()) == [("empty", 2), ("loaded", 2)]
    assert rows(read_table(spark, f"{house}/transactions").select("transaction_id_dd")) == [("t1",), ("t2",)]


def test_csv_jobs_keep_damaged_lines_apart(spark, folder, tmp_path, capsys):
    house, csv = str(tmp_path / "house"), folder / "merchants.csv"
    csv.write_text('merchant_id,merchant_name,category_id,city_id\nm1,"Cash\nand carry",1,34\nm2,Fuel\n,Nameless,1,34\n')
    load = ["load-dimension", "--table", "merchants", "--csv", str(csv), "--warehouse", house, "--as-of", "2024-03-01", "--quoted-breaks"]
    assert jobs.run(spark, load) == 0
    assert "merchants: 3 lines, 1 malformed, 2 rejected, 1 to load" in capsys.readouterr().out
    assert rows(read_table(spark, f"{house}/merchants").select("merchant_name")) == [("Cash\nand carry",)]
    kept = read_table(spark, f"{house}/rejected_merchants")
    assert rows(kept.select("reject_reason", "_corrupt_record")) == [("malformed line", "m2,Fuel"), ("no key", None)]
    assert '"merchant_name":"Nameless"' in kept.where("reject_reason = 'no key'").first()["source_values"]


def test_days_that_left_the_source_are_named(spark, folder, tmp_path, capsys):
    house, csv = str(tmp_path / "house"), folder / "transactions.csv"
    load = ["load-transactions", "--csv", str(csv), "--warehouse", house, "--start", "2024-01-01", "--end", "2024-02-28"]
    assert jobs.run(spark, load) == 0
    assert "no longer has" not in capsys.readouterr().out
    csv.write_text("".join(line for line in csv.read_text().splitlines(True) if not line.startswith("t1,")))
    assert jobs.run(spark, load) == 1
    assert "the source no longer has, left as they were: 2024-01-05" in capsys.readouterr().out
    assert rows(read_table(spark, f"{house}/transactions").select("transaction_id_dd")) == [("t1",), ("t2",)]


def test_older_layout_daily_totals(spark, tmp_path, capsys):
    raw = tmp_path / "t.csv"
    raw.write_text(
        "transaction_id,account_number,customer_id,transaction_date,transaction_time,transaction_amount,transaction_type,"
        "merchant_description,category,balance_after_transaction,location,channel\n"
        "00000000001,ACC1,C1,2025-05-18,17:44:00,12.50,debit,Shop,gas,100.00,Ankara,POS\n"
        "00000000002,ACC1,C1,2025-05-18,18:44:00,2.50,debit,Shop,gas,97.50,Ankara,POS\n"
    )
    assert jobs.run(spark, ["build-daily", "--csv", str(raw), "--target", str(tmp_path / "daily"), "--show", "3"]) == 0
    assert "2025-05-18" in capsys.readouterr().out
    for form in ("day", "moment"):
        args = ["load-legacy", "--csv", str(raw), "--form", form, "--target", str(tmp_path / form)]
        assert jobs.run(spark, args) == 0
    assert {str(r["transaction_date"]) for r in read_table(spark, str(tmp_path / "day")).collect()} == {"2025-05-18"}
    assert {str(r["ts"])[11:] for r in read_table(spark, str(tmp_path / "moment")).collect()} == {"17:44:00", "18:44:00"}
    found = read_table(spark, str(tmp_path / "daily")).first()
    assert (found["account_number"], found["day"], found["tx_count"], float(found["total_amount"])) == ("ACC1", "2025-05-18", 2, 15.0)
    assert jobs.run(spark, ["clean-legacy", "--csv", str(raw), "--target", str(tmp_path / "clean")]) == 0
    assert read_table(spark, str(tmp_path / "clean")).count() == 2
