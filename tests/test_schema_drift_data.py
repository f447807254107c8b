"""Changes of the test data's files against a plain version: csv and json modules, sets of values, every pair of columns."""

import collections
import csv
import datetime as dt
import itertools
import json
import os
import re
import unicodedata

import pytest

from lexloom.sources.schema_drift import Drift
from tests.conftest import rows

DATE_FORMS = ("%Y-%m-%d", "%m/%d/%Y", "%d/%m/%Y", "%d %b %Y", "%d %B %Y", "%Y/%m/%d", "%b %d, %Y")


def name_of(s):
    return re.sub("[^a-z0-9]+", "_", s.lower()).strip("_")


def value_of(s):
    s = s if isinstance(s, str) else "" if s is None else json.dumps(s)
    s = s.strip().strip('"').strip()
    return None if s.upper() in ("", "NULL", "N/A", "\\N", "-") else s


def dates(s):
    out = set()
    for form in DATE_FORMS:
        try:
            out.add(dt.datetime.strptime(s, form).date())
        except ValueError:
            pass
    return out


def kind_of(s):
    if re.fullmatch("[0-9]+", s):
        return "integer"
    if re.fullmatch(r"[+-]?[0-9]*\.[0-9]+", s):
        return "decimal"
    if s.lower() in ("true", "false"):
        return "boolean"
    if dates(s) or re.fullmatch(r"\d{4}-\d\d-\d\d", s):
        return "date"
    day, _, time = s.replace("T", " ").partition(" ")
    return "timestamp" if dates(day) and re.fullmatch(r"\d\d?:\d\d(:\d\d)?Z?", time) else "text"


def same(a, b):
    day = lambda s: dates(s) | dates(re.split("[T ]", s)[0]) | ({dt.datetime.strptime(s, "%Y%m%d").date()} if re.fullmatch(r"(19|20)\d\d(0[1-9]|1[0-2])(0[1-9]|1\d|2[0-8])", s) else set())
    if day(a) & day(b):
        return True
    plain = lambda s: "".join(c for c in unicodedata.normalize("NFKD", s).lower() if c.isalnum())
    number = lambda s: (m := re.fullmatch(r"[A-Za-z]*[ -]?0*(\d+?)(\.0*)?[ -]?[A-Za-z]*", s)) and m[1]
    flag = lambda s: {"live": 1, "l": 1, "1": 1, "true": 1, "yes": 1, "y": 1, "t": 1, "dead": 0, "d": 0, "0": 0, "false": 0, "no": 0, "n": 0, "f": 0}.get(s.lower())
    return plain(a) == plain(b) or (number(a) is not None and number(a) == number(b)) or (flag(a) is not None and flag(a) == flag(b))


def files_of(lines):
    """(feed, number) -> columns in use, type by column, serial -> values."""
    by_file = collections.defaultdict(dict)
    for r in lines:
        by_file[r.feed_id, r.file_no].setdefault(r.line_no, r)
    out = {}
    for key, by_line in by_file.items():
        records, n = [], len(by_line)
        if by_line[min(by_line)].file_format == "delimited":
            n -= 1
            head = by_line[0].raw.lstrip("﻿")
            separator = max(",;|\t", key=head.count)
            columns = [name_of(c) for c in next(csv.reader([head], delimiter=separator))]
            for no, r in by_line.items():
                fields = next(csv.reader([r.raw], delimiter=separator), [])
                if no and len(fields) == len(columns):
                    records.append(dict(zip(columns, map(value_of, fields), strict=True)))
        else:
            for r in by_line.values():
                try:
                    parsed = json.loads(r.raw)
                except ValueError:
                    continue
                if isinstance(parsed, dict):
                    records.append({name_of(k): value_of(v) for k, v in parsed.items()})
            seen = collections.Counter(k for r in records for k in r)
            columns = [c for c, k in seen.items() if 2 * k >= n]
        kinds = {}
        for c in columns:
            counted = collections.Counter(kind_of(r[c]) for r in records if r.get(c) is not None)
            kinds[c] = next((k for k, m in counted.items() if 2 * m > sum(counted.values())), None)
        serial = max(columns, key=lambda c: len({r[c] for r in records if re.fullmatch("10[0-9]{6}", r.get(c) or "")}))
        out[key] = (set(columns), kinds, {r[serial]: r for r in records if r.get(serial)})
    return out


def changes_of(lines):
    files, found = files_of(lines), set()
    for feed, keys in itertools.groupby(sorted(files), key=lambda k: k[0]):
        for old_key, new_key in itertools.pairwise(keys):
            (old, old_kinds, old_rows), (new, new_kinds, new_rows) = files[old_key], files[new_key]
            shares = {}
            for a, b in itertools.product(old - new, new - old):
                met = [(old_rows[s].get(a), new_rows[s].get(b)) for s in old_rows.keys() & new_rows.keys()]
                met = [(x, y) for x, y in met if x is not None and y is not None]
                if met:
                    shares[a, b] = sum(same(x, y) for x, y in met) / len(met)
            renamed = {}
            for (a, b), share in sorted(shares.items(), key=lambda x: -x[1]):
                if share >= 2 / 3 and a not in renamed and b not in renamed.values():
                    renamed[a] = b
            at = (feed, new_key[1])
            found |= {(*at, "renamed", a, b) for a, b in renamed.items()} | {(*at, "removed", a, "") for a in old - new - renamed.keys()} | {(*at, "added", "", b) for b in new - old - set(renamed.values())}
            for a, b in [*((c, c) for c in old & new), *renamed.items()]:
                if old_kinds[a] and new_kinds[b] and old_kinds[a] != new_kinds[b]:
                    found.add((*at, "retyped", a, b))
    return sorted(found, key=repr)


@pytest.mark.parametrize("scale", os.environ.get("LEXLOOM_DRIFT_SCALES", "sf0.01").split(","))
def test_changes_of_the_test_data(spark, folder, scale):
    lines = spark.read.parquet(f"{os.path.dirname(folder)}/{scale}/case_file_lines.parquet")
    mine, plain = rows(Drift(lines).changes()), changes_of(lines.collect())
    assert set(mine) - set(plain) == set() and set(plain) - set(mine) == set() and len(mine) > 20
