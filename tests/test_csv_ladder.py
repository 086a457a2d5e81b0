"""Extract ladder from files to verdicts, on orders and their lines as CSV."""

import pytest

from twinledger.functions.normalise import CellRules
from twinledger.plans import wording
from twinledger.plans.ladders import Settings, ViewSpec, gather, run_extracts
from twinledger.sources.extracts import read_extract

HEAD = ("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_clerk")
#: Orders as (key, status, price, day, clerk).
ORDERS = [(k, "OFP"[k % 3], f"{k * 731 % 9000}.{k % 90 + 10}", f"1995-0{k % 9 + 1}-1{k % 10}", f"Clerk#{k % 4}") for k in range(1, 13)]


def text(rows, head=HEAD, end="\n"):
    return end.join(",".join("" if c is None else str(c) for c in r) for r in (head, *rows)) + end


def changed(key, column, value, rows=ORDERS):
    at = HEAD.index(column)
    return [(*r[:at], value, *r[at + 1 :]) if r[0] == key else r for r in rows]


class Outcome:
    def __init__(self, run):
        self.tier = {t.tier: t for t in run.tiers.collect()}
        self.status = {name: t.status for name, t in self.tier.items()}
        self.view = run.views.first()
        self.verdict, self.notes = self.view.verdict, self.view.notes
        self.column = {c.column: c for c in run.columns.collect()}
        self.mismatches = {name: int(c.mismatches) for name, c in self.column.items()}
        self.samples = run.samples.collect() if run.samples is not None else []


@pytest.fixture
def compare(spark, tmp_path):
    def run(left, right, settings=Settings(sample_rows=5), **spec):
        sides = {}
        for side, content in {"left": left, "right": right}.items():
            if content is not None:
                content = content if isinstance(content, str) else text(content)
                (tmp_path / f"{side}.csv").write_text(content, encoding="utf-8")
            sides[side] = None if content is None else read_extract(spark, str(tmp_path / f"{side}.csv"))
        view = ViewSpec("orders", **{"grain": ("o_orderkey",), **spec})
        return Outcome(gather(spark, [run_extracts(spark, view, sides["left"], sides["right"], settings, "north")]))

    return run


def test_a_file_agrees_with_itself_in_any_order(compare):
    out = compare(ORDERS, ORDERS[::-1])
    assert set(out.status.values()) == {"PASS"} and len(out.status) == 6
    assert out.verdict == "PASS" and not out.column


def test_other_renderings_of_the_same_orders(compare):
    other = [(k, s, p + "000", f"{d} 00:00:00.00Z", "\\N" if k == 3 else c) for k, s, p, d, c in ORDERS]
    left = [(k, s, p, f"{d} 00:00:00", None if k == 3 else c) for k, s, p, d, c in ORDERS]
    assert compare(left, other).verdict == "PASS"


def test_flags_spelled_as_words_or_digits(compare):
    left, right = [(r[0], r[0] % 2) for r in ORDERS], [(r[0], "yes" if r[0] % 2 else "F") for r in ORDERS]
    head = ("o_orderkey", "urgent")
    rules = CellRules(boolean_columns=("urgent",))
    assert compare(text(left, head), text(right, head), cell_rules=rules).verdict == "PASS"
    assert compare(text(left, head), text(right, head)).mismatches == {"urgent": 12}


def test_a_changed_cell_is_found_and_shown(compare):
    out = compare(ORDERS, changed(7, "o_clerk", "nobody"))
    assert out.verdict == "DIFFS FOUND" and out.mismatches == {"o_clerk": 1}
    assert (out.status["C2"], out.status["C3"], out.status["C4"], out.status["C5"]) == ("PASS", "PASS", "FAIL", "SKIPPED")
    assert out.tier["C5"].reason == wording.DIFFERS
    (sample,) = out.samples
    assert (sample.left_value, sample.right_value, sample.row) == ("Clerk#3", "nobody", '{"o_orderkey":"7"}')


def test_fingerprints_on_request_despite_differences(compare):
    assert compare(ORDERS, changed(7, "o_clerk", "x"), Settings(always_fingerprint=True)).status["C5"] == "FAIL"


@pytest.mark.parametrize("head", [(*HEAD[:3], "o_clerk", "o_orderdate"), (*HEAD[:4], "o_comment")], ids=["moved", "renamed"])
def test_another_header_ends_the_ladder(compare, head):
    out = compare(ORDERS, text(ORDERS, head))
    assert out.verdict == "HEADER DRIFT" and out.status == {"C0": "PASS", "C1": "FAIL"}
    assert wording.HEADERS_DIFFER in out.notes


def test_orders_of_one_side_only(compare):
    out = compare(ORDERS[2:], ORDERS[:-1])
    keys = out.tier["C3"]
    assert (keys.left_only, keys.right_only, int(keys.shared)) == (1, 2, 9)
    # 10 and 11 rows, and the shared orders agree.
    assert out.status["C2"] == "FAIL" and out.status["C4"] == "PASS"
    assert sorted(s.column for s in out.samples) == ["in_left_not_right", "in_right_not_left", "in_right_not_left"]


@pytest.mark.parametrize("tolerance, verdict", [(9.0, "PASS (DIFFS ACCEPTED)"), (8.0, "DIFFS FOUND")])
def test_one_order_of_twelve_missing(compare, tolerance, verdict):
    assert compare(ORDERS, ORDERS[1:], Settings(threshold_pct=tolerance)).verdict == verdict


@pytest.mark.parametrize("rule", ["year(prod_value) < 1995 and uat_value is null", "year(prod_value) < 1995 and uat_value is None"])
def test_a_rule_explains_some_differences(compare, rule):
    left = changed(2, "o_orderdate", "1994-12-31", changed(5, "o_orderdate", "1993-01-01"))
    right = changed(2, "o_orderdate", None, changed(5, "o_orderdate", "1996-06-06"))
    out = compare(left, right, accepted=(("o_orderdate", "not migrated", rule),))
    found = out.column["o_orderdate"]
    assert (int(found.mismatches), int(found.residual), found.status) == (2, 1, "FAIL")
    assert found.reason == f"not migrated{wording.COVERS}1{wording.OF}2{wording.OPEN}"
    assert [(s.left_value, s.right_value) for s in out.samples] == [("1993-01-01", "1996-06-06")]


def test_null_is_a_key_like_any_other(compare):
    lines = text([(1, None, "A"), (1, 2, "B"), (None, None, "C")], ("o_orderkey", "line", "flag"))
    out = compare(lines, lines, grain=("o_orderkey", "line"))
    assert out.verdict == "PASS" and int(out.tier["C3"].shared) == 3


@pytest.mark.parametrize("sides", [(ORDERS, None), (None, ORDERS), (None, None)])
def test_without_a_file_there_is_nothing_to_compare(compare, sides):
    out = compare(*sides)
    assert out.verdict == "BLOCKED" and out.status == {"C0": "FAIL"}


def test_of_repeated_orders_the_first_row_counts(compare):
    again = [*ORDERS, (4, "X", "0", "1990-01-01", "late copy")]
    out = compare(again, ORDERS)
    assert out.tier["C3"].left_dups == 1 and out.status["C4"] == "PASS"
    assert wording.FIRST_ROWS_ONLY in out.notes


def test_without_keys_only_whole_contents_are_compared(compare):
    same, other = compare(ORDERS, ORDERS, grain=()), compare(ORDERS, changed(9, "o_orderstatus", "?"), grain=())
    assert same.verdict == "PASS (NO GRAIN)" and other.verdict == "DIFFS FOUND"
    for out in (same, other):
        assert (out.status["C3"], out.status["C4"]) == ("SKIPPED", "SKIPPED") and out.tier["C4"].reason == wording.NO_KEYS
    assert other.status["C5"] == "FAIL"


def test_acceptance_by_configuration(compare):
    marks = (("C4", "ticket 12"), ("C8", None))
    out = compare(ORDERS, changed(1, "o_totalprice", "1"), overrides=marks)
    assert (out.tier["C4"].status, out.tier["C4"].accept_reason) == ("ACCEPTED", "ticket 12")
    assert out.verdict == "PASS (DIFFS ACCEPTED)" and out.tier["C5"].reason == wording.TOLERATED
    assert any("C8" in n for n in out.notes)


def test_no_acceptance_reaches_the_header(compare):
    assert compare(ORDERS, text(ORDERS, (*HEAD[:4], "other")), overrides=(("*", None),)).verdict == "HEADER DRIFT"


def test_short_and_long_rows_are_repaired_and_counted(compare):
    head = ("o_orderkey", "flag", "o_comment")
    ragged = "﻿O_ORDERKEY,Flag,o_Comment\n1,A\n2,B,two,more\n3,C,\"three\nlines\"\n"
    out = compare(ragged, text([(1, "A", None), (2, "B", "two"), (3, "C", '"three\nlines"')], head))
    assert out.verdict == "PASS" and [n for n in out.notes if n.startswith("left: 2 row(s)")]


def test_a_missing_cell_is_null_and_a_blank_one_is_not_if_blanks_count(compare):
    out = compare("o_orderkey,flag\n1\n2,x\n", "o_orderkey,flag\n1,\n2,x\n", cell_rules=CellRules(blank_as_null=False))
    assert out.mismatches == {"flag": 1}
    assert (out.samples[0].left_value, out.samples[0].right_value) == (None, "")


def test_a_file_without_a_header(compare):
    assert compare(ORDERS, "").verdict == "HEADER DRIFT"


def test_samples_read_the_stored_alignment(spark, tmp_path):
    """What comes after the counts parses no file again."""
    sides = []
    for name, rows in (("l", ORDERS), ("r", changed(3, "o_clerk", "someone"))):
        (tmp_path / f"{name}.csv").write_text(text(rows), encoding="utf-8")
        sides.append(read_extract(spark, str(tmp_path / f"{name}.csv")))
    run = run_extracts(spark, ViewSpec("orders", grain=("o_orderkey",)), *sides, Settings(sample_rows=5), "north")
    samples = gather(spark, [run]).samples
    plan = samples._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "FileScan text" not in plan and samples.count() == 1
