"""Changes between snapshots: against a brute-force version, and the defined cases."""

import datetime as dt
import random

from tests.conftest import rows

from lexloom.operators.snapshot_diff import corpus_changes

RECORDS = "record_id bigint, provider_id string, source_ref string, status string, vintage string, loaded_at timestamp, step string, _key string"
LEDGER = "ledger_seq bigint, provider_id string, vintage string"


def at(n):
    return dt.datetime(2030, 1, 1) + dt.timedelta(hours=n)


def brute(records, ledger):
    vintages = {}
    for _, provider, vintage in sorted(ledger):
        if vintage not in vintages.setdefault(provider, []):
            vintages[provider].append(vintage)
    status = {}
    for _, provider, ref, st, vintage, when, *_ in sorted(records, key=lambda r: r[5]):
        if ref is not None:
            status.setdefault((provider, vintage), {})[ref.strip().lower()] = (st or "unknown").strip().lower()
    found = []
    for provider, order in vintages.items():
        for old, new in zip(order, order[1:]):
            a, b = status.get((provider, old), {}), status.get((provider, new), {})
            found += [(provider, r, new, "added") for r in b.keys() - a.keys()] + [(provider, r, new, "removed") for r in a.keys() - b.keys()]
            found += [(provider, r, new, "changed") for r in a.keys() & b.keys() if a[r] != b[r]]
    return sorted(found, key=repr)


def test_against_brute_force(spark):
    draw = random.Random(3)
    ledger = [(i * 3 + j, p, v) for j, p in enumerate("ab") for i, v in enumerate(["v1", "v2", "v9", "v3"])]
    records = [
        (i, draw.choice("abc"), draw.choice([" R1", "r1 ", "R2", "r3", "hot", "hot", "hot"]), draw.choice(["live", " LIVE", "dead", None, "Unknown"]), draw.choice(["v1", "v2", "v9", "v3", "not accepted"]), at(i), "x", "y")
        for i in range(400)
    ]
    found = corpus_changes(spark.createDataFrame(records, RECORDS), spark.createDataFrame(ledger, LEDGER))
    assert rows(found) == brute(records, ledger)


def test_defined_cases(spark):
    ledger = spark.createDataFrame([(1, "p", "v1"), (2, "p", "v2"), (3, "p", "v1"), (4, None, "v1"), (5, "p", None)], LEDGER)
    records = spark.createDataFrame([
        (1, "p", "r", "live", "v1", at(5), "", ""), (2, "p", "r", "dead", "v1", None, "", ""),  # a null time is the earliest
        (3, "p", "r", "LIVE ", "v2", at(1), "", ""), (4, "p", None, "live", "v2", at(1), "", ""), (5, None, "r", "live", "v2", at(1), "", ""),
        (6, "p", "tie", "live", "v1", at(1), "", ""), (7, "p", "tie", "dead", "v1", at(1), "", ""), (8, "p", "tie", "live", "v2", at(1), "", ""), (9, "p", "tie", "dead", "v2", at(1), "", ""),
    ], RECORDS)
    assert rows(corpus_changes(records, ledger)) == []  # ties go to one of them, alike in both snapshots
    assert rows(corpus_changes(records.limit(0), ledger)) == []
    assert rows(corpus_changes(records, ledger.limit(0))) == []


def test_a_snapshot_without_rows_removes_all(spark):
    ledger = spark.createDataFrame([(1, "p", "v1"), (2, "p", "v2"), (3, "p", "v3")], LEDGER)
    records = spark.createDataFrame([(1, "p", "r", None, "v1", at(1), "", ""), (2, "p", "r", "unknown", "v3", at(1), "", "")], RECORDS)
    assert rows(corpus_changes(records, ledger)) == [("p", "r", "v2", "removed"), ("p", "r", "v3", "added")]
