"""Tables kept beside the sources: paying creditors, payments by event date."""

import random
from datetime import timedelta

import pytest

from riskwatch import config as c
from riskwatch import run
from riskwatch.operators import staging
from riskwatch.plans import features as f
from riskwatch.sources import Sources
from riskwatch.sources import seen as kept
from riskwatch.sources.payment_events import EVENTS, payment_events, write_payment_events
from riskwatch.sources.seen import refresh_seen, run_dates
from tests.tables import AS_OF, MERCHANT, ORGANISATION, SCHEMAS, days, make_sources, paid
from tests.test_plans import no_broadcast, plan, scans_of  # noqa: F401


def random_payments(seed, n=300):
    pick = random.Random(seed)
    rows = []
    for _ in range(n):
        flags = {k: pick.choice([True, True, False, None]) for k in ("is_paid", "is_charged_back", "is_failed", "is_late_failure", "is_refunded")}
        dates = {
            k: pick.choice([None, days(pick.choice([-800, -366, -365, -364, -91, -90, -31, -30, -5, -1, 0, 3, 7]))])
            for k in ("charge_date", "charged_back_date", "failed_or_late_failure_date", "refund_created_at")
        }
        rows.append({"creditor_id": pick.choice(["C1", "C2", "C3", "C4", None]), "amount_gbp": pick.randrange(1, 900) / 4, **flags, **dates})
    return rows


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def on_disk(spark, tmp_path):
    """Sources over parquet files made of the given tables."""

    def write(**tables):
        made = make_sources(spark, **tables)
        paths = {name: str(tmp_path / name) for name in SCHEMAS}
        for name, path in paths.items():
            made.table(name).write.parquet(path)
        return Sources.from_parquet(spark, paths)

    return write


# --- Paying creditors -------------------------------------------------------


def test_paid_amount_is_the_same_with_the_kept_table(spark, tmp_path):
    rows = random_payments(1)
    tables = make_sources(spark, payment=rows)
    seen = refresh_seen(spark, tables, str(tmp_path / "seen"), AS_OF)
    assert rows_of(f.paid_last_year(seen, AS_OF)) == rows_of(f.paid_last_year(tables, AS_OF))
    assert {r["creditor_id"] for r in seen.table("seen_creditor").collect()} == {r["creditor_id"] for r in rows}


def test_runs_add_new_creditors_and_a_rebuild_gives_the_same(spark, tmp_path):
    path, history = str(tmp_path / "seen"), []
    old = [paid("OLD", -900), paid("OLD", -20), {"creditor_id": None, "charge_date": days(-700)}]
    for back in (5, 3, 1):
        history.append([*old, *[paid(f"N{k}", -k) for k in range(back, 9)]])
        # a late row, one without a date and a coming one
        history[-1] += [paid("LATE", -25)] if back < 5 else []
        history[-1] += [{"creditor_id": "UNDATED"}, paid("SOON", 4)] if back < 3 else []
        day = AS_OF - timedelta(days=back)
        sources = refresh_seen(spark, make_sources(spark, payment=history[-1]), path, day)
        known = {r["creditor_id"] for r in sources.table("seen_creditor").collect()}
        assert known == {r["creditor_id"] for r in history[-1]}
        assert sources.table("seen_creditor").count() == len(known)
    assert len(run_dates(spark, path)) == 3
    # The same day again replaces its own directory and changes nothing.
    again = refresh_seen(spark, make_sources(spark, payment=history[-1]), path, AS_OF - timedelta(days=1))
    assert again.table("seen_creditor").count() == len(known) and len(run_dates(spark, path)) == 3
    rebuilt = refresh_seen(spark, make_sources(spark, payment=history[-1]), path, AS_OF, rebuild=True)
    assert {r["creditor_id"] for r in rebuilt.table("seen_creditor").collect()} == known


def test_no_payments_outside_the_year_are_read_once_the_table_exists(spark, on_disk, tmp_path, monkeypatch):
    tables = on_disk(payment=[paid("C1", -3), paid("C2", -500)], creditor=[MERCHANT], organisation=[ORGANISATION])
    path = str(tmp_path / "seen")
    refresh_seen(spark, tables, path, AS_OF - timedelta(days=1))
    looked_at, candidates = [], kept._candidates
    monkeypatch.setattr(kept, "_candidates", lambda *a: looked_at.append(candidates(*a)) or looked_at[-1])
    seen = refresh_seen(spark, tables, path, AS_OF)
    year = (AS_OF - timedelta(days=365)).isoformat()
    assert year in scans_of(plan(looked_at[0]))[0]
    for df in (f.paid_last_year(seen, AS_OF), run(c.PROCESS_INSOLVENCY, seen, AS_OF), run(c.PROCESS_SCORE_DROP, seen, AS_OF)):
        payments = [scan for scan in scans_of(plan(df)) if "/payment]" in scan]
        assert len(payments) == 1 and "GreaterThanOrEqual(charge_date" in payments[0] and "LessThan" in payments[0]


def test_history_is_not_looked_up_without_an_idle_category(spark, on_disk, monkeypatch):
    merchants = [{**MERCHANT, "id": f"C{k}", "merchant_category_code": code} for k, code in enumerate(["A", "A", "B"])]
    asked, ever = [], f.ever_paying
    monkeypatch.setattr(f, "ever_paying", lambda sources: asked.append(1) or ever(sources))
    busy = on_disk(payment=[paid("C0", -3), paid("C2", -9)], creditor=merchants)
    _, categories = f.peer_totals(busy, AS_OF)
    assert asked == [] and {r["merchant_category_code"] for r in categories.collect()} == {"A", "B"}
    monkeypatch.setattr(staging, "shared_folder", lambda _: None)
    monkeypatch.setattr(f, "shared_folder", lambda _: None)
    lazy = f.peer_totals(busy, AS_OF)[1]
    assert asked == [1] and rows_of(lazy) == rows_of(categories)


def test_idle_categories_come_from_the_kept_table(spark, tmp_path):
    merchants = [{**MERCHANT, "id": f"C{k}", "merchant_category_code": code} for k, code in enumerate(["A", "B", "D", None])]
    tables = make_sources(spark, payment=[paid("C0", -3), paid("C1", -500), paid("C3", -400)], creditor=merchants)
    seen = refresh_seen(spark, tables, str(tmp_path / "seen"), AS_OF)
    without_history = seen.replace(payment=tables.table("payment").where("charge_date > '2024-10-01'"))
    found = {r["merchant_category_code"]: r["mcc_payment_vol_last_12m"] for r in f.peer_totals(without_history, AS_OF)[1].collect()}
    assert found == {"A": 1, "B": 0, None: 0}
    assert rows_of(f.peer_totals(tables, AS_OF)[1]) == rows_of(f.peer_totals(without_history, AS_OF)[1])


# --- Payments by event date -------------------------------------------------


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_metrics_are_the_same_from_both_layouts(spark, tmp_path, seed):
    tables = make_sources(spark, payment=random_payments(seed))
    path = str(tmp_path / "events")
    write_payment_events(tables, path, AS_OF)
    write_payment_events(tables, path, AS_OF)
    stored = tables.replace(payment_event=spark.read.parquet(path))
    for feature in (f.payment_window_metrics, f.payment_activity, f.paid_last_year):
        assert rows_of(feature(stored, AS_OF)) == rows_of(feature(tables, AS_OF))


def test_each_event_is_a_row_of_its_day(spark):
    rows = [{"creditor_id": "C1", "charge_date": days(-3), "refund_created_at": days(-1)}, {"creditor_id": "C2"}]
    found = payment_events(make_sources(spark, payment=rows).table("payment")).collect()
    assert {(r["event"], str(r["event_date"])) for r in found} == {("charge_date", "2024-11-04"), ("refund_created_at", "2024-11-06")}
    assert all(r["charge_date"] == days(-3) for r in found)


def test_event_windows_prune_partitions(spark, on_disk, tmp_path):
    tables = on_disk(payment=random_payments(4), creditor=[MERCHANT], organisation=[ORGANISATION])
    path = str(tmp_path / "by_event")
    write_payment_events(tables, path, AS_OF)
    stored = tables.replace(payment_event=spark.read.parquet(path))
    metrics = f.payment_window_metrics(stored, AS_OF)
    scan = scans_of(plan(metrics))
    filters = scan[0].split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert len(scan) == 1 and all(name in filters for name in EVENTS)
    assert filters.count("event_date#") >= 5
    read = {(r["event"], r["event_date"]) for r in f.payments_let_in(stored, f.TRAILING, AS_OF).collect()}
    assert all(d >= AS_OF - timedelta(days=365 if e == "charge_date" else 90) for e, d in read)
    whole = run(c.PROCESS_CHARGEBACK, stored, AS_OF, c.ChargebackParams(only_alerts=False))
    assert not [s for s in scans_of(plan(whole)) if "/payment]" in s]
