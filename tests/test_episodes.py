"""Edge cases of the status history."""

from __future__ import annotations

import pytest

from caseweave.functions.dates import ReportWindow
from caseweave.operators import episodes as ep


def status(pid, *events):
    return [
        {"status_id": pid * 100 + i, "participant_id": pid, "status_date": d, "pstatus": s}
        for i, (d, s) in enumerate(events)
    ]


@pytest.fixture()
def spans(table, window, rows):
    def run(*events, **options):
        return rows(
            ep.episodes(table("pstatus", status(1, *events)), window, **options),
            "active_date", "closed_date",
        )

    return run


def test_no_episode_without_active(spans):
    assert spans() == []
    assert spans(("2023-02-01", "Closed")) == []


def test_window_ends_are_inclusive(spans):
    assert spans(("2023-12-31", "Active")) == [("2023-12-31", None)]
    assert spans(("2024-01-01", "Active")) == []
    assert spans(("2022-01-01", "Active"), ("2023-01-01", "Closed")) == [
        ("2022-01-01", "2023-01-01")
    ]
    assert spans(("2022-01-01", "Active"), ("2022-12-31", "Closed")) == []


def test_closed_after_window_keeps_its_date(spans):
    assert spans(("2023-05-01", "Active"), ("2024-05-01", "Closed")) == [
        ("2023-05-01", "2024-05-01")
    ]


def test_repeated_active_counts_from_the_second(spans):
    events = [("2023-01-10", "Active"), ("2023-02-10", "Active"), ("2023-03-10", "Closed")]
    assert spans(*events) == [("2023-02-10", "2023-03-10")]


def test_other_status_breaks_the_pair(spans):
    events = [("2023-01-10", "Active"), ("2023-02-10", "On hold"), ("2023-03-10", "Closed")]
    assert spans(*events) == []
    assert spans(("2023-01-10", "Active"), ("2023-02-10", None)) == []


def test_same_day_is_ordered_by_status_id(spans):
    day = "2023-04-01"
    assert spans((day, "Active"), (day, "Closed")) == [(day, day)]
    assert spans((day, "Closed"), (day, "Active")) == [(day, None)]
    assert spans((day, "Active"), (day, "Closed"), (day, "Active"), (day, "Closed")) == [(day, day)]
    assert spans((day, "Active"), (day, "Closed"), (day, "Active"), ("2023-05-01", "Closed")) == [
        (day, day), (day, "2023-05-01"),
    ]


def test_case_and_null_dates(spans):
    assert spans(("2023-01-10", "ACTIVE"), (None, "Closed"), ("2023-02-10", "closed")) == [
        ("2023-01-10", "2023-02-10")
    ]


def test_slots_limit_the_history(spans):
    events = [
        (f"2023-{m:02d}-01", s) for m, s in enumerate(["Active", "Closed"] * 4, start=1)
    ]
    assert len(spans(*events)) == 4
    # The newest five rows start with a lone 'Closed'.
    assert len(spans(*events, max_slots=5)) == 2


def test_unknown_participants_have_no_stints(table, window, rows):
    history = table("pstatus", status(1, ("2023-01-10", "Active")) + status(2, ("2023-01-10", "Active")))
    people = table("participants", [{"participant_id": 1, "first_name": "A", "last_name": "B"}])
    found = ep.stints(history, people, window)
    assert rows(found, "participant_id", "first_name") == [(1, "A")]
    assert rows(ep.stint_count(found)) == [(1, 1)]
    assert rows(ep.stint_totals(found)) == [(1, 1)]
    assert rows(ep.stint_totals(found.limit(0))) == [(0, 0)]


def test_wide_history_and_anomalies(table, window, rows):
    history = table(
        "pstatus",
        status(1, ("2022-01-01", "Active"), ("2022-02-01", "Active"), ("2022-03-01", "Closed"))
        + status(2, ("2021-01-01", "Closed"), ("2021-02-01", "Closed"))
        + status(3, ("2022-01-01", "Active"), ("2022-02-01", "Closed")),
    )
    people = table("participants", [{"participant_id": i} for i in (1, 2, 3)])
    wide = ep.status_wide(history, 5)
    assert rows(wide, "participant_id", "pstatus1", "status_date2", "pstatus4") == [
        (1, "Closed", "2022-02-01", None), (2, "Closed", "2021-01-01", None),
        (3, "Closed", "2022-01-01", None),
    ]
    found = ep.status_anomalies(history, people, [2022, 2023])
    assert rows(found, "participant_id", "pstatus", "status_date", "next_date") == [
        (1, "Active", "2022-01-01", "2022-02-01")
    ]
    assert rows(ep.max_status_count(history, [2022, 2023])) == [(3,)]


def test_case_tally_counts_later_classes(table, window, rows):
    history = table(
        "pstatus",
        status(1, ("2022-01-01", "Active"), ("2023-03-01", "Closed"))
        + status(2, ("2024-01-01", "Active"))
        + status(3, ("2024-01-01", "Active"), ("2024-02-01", "Closed"))
        + status(4, ("2023-01-01", "Active"), ("2023-02-01", "Closed"),
                 ("2023-03-01", "Active"), ("2023-04-01", "Closed")),
    )
    people = table("participants", [{"participant_id": i} for i in (1, 2, 3, 4)])
    tally = ep.stint_case_tally(history, people, window)
    assert rows(tally) == [
        ("#2", 1, 1), ("#3", 0, 0), ("#4", 0, 0), ("#5", 1, 2), ("#6", 0, 0), ("#7", 0, 0),
        ("#8", 1, 1), ("#9", 1, 1),
    ]


def test_checks_see_the_whole_history(table, window, rows):
    """The oldest of forty statuses counts like the newest; slots are an option."""
    days = [(f"{1990 + i // 2}-0{1 + 5 * (i % 2)}-01", "Active" if i % 2 == 0 else "Closed") for i in range(40)]
    days.insert(1, ("1990-02-01", "Active"))
    history = table("pstatus", status(1, *days))
    people = table("participants", [{"participant_id": 1}])
    found = ep.status_anomalies(history, people, [1990])
    assert rows(found, "status_date", "next_date") == [("1990-01-01", "1990-02-01")]
    assert ep.status_anomalies(history, people, [1990], max_slots=5).count() == 0
    early = ReportWindow("1990-01-01", "1990-12-31")
    tally = {r[0]: r[1:] for r in rows(ep.stint_case_tally(history, people, early))}
    assert tally["#5"] == (1, 1) and tally["#8"] == (1, 19)
    assert dict((r[0], r[1:]) for r in rows(ep.stint_case_tally(history, people, early, 5)))["#8"] == (1, 2)


def test_tally_agrees_with_stints(spark, rows):
    """Classes that meet the window, counted from the episodes themselves."""
    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.01"
    q = entry.queries()
    counts: dict[tuple, set] = {}
    for r in q["stints"](spark, sf).collect():
        began = "before" if str(r.active_date) < "1997-01-01" else "in"
        ended = "open" if r.closed_date is None else "in" if str(r.closed_date) <= "1997-12-31" else "after"
        counts.setdefault((ended, began), set()).add(r)
    tally = {r.case_label: (r.n_participants, r.n_rows) for r in q["stint_case_tally"](spark, sf).collect()}
    for label, key in ep.EPISODE_CLASSES.items():
        if label not in ("#8", "#9"):
            found = counts.get(key, set())
            assert tally[label] == (len({r.participant_id for r in found}), len(found)), label


def test_newest_slots_give_the_same_episodes_as_the_wide_view(spark, rows):
    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.01"
    want = set()
    for r in entry._wide(spark, sf).collect():
        history = [(r[f"pstatus{i}"], r[f"status_date{i}"]) for i in range(5, 0, -1) if r[f"status_date{i}"]]
        for (state, day), (then, until) in zip(history, [*history[1:], (None, None)], strict=True):
            if state == "Active" and then in (None, "Closed") and str(day) <= "1997-12-31":
                if until is None or str(until) >= "1997-01-01":
                    want.add((r.participant_id, day, until))
    got = entry.queries()["stints_max_slots"](spark, sf).collect()
    assert {(r.participant_id, r.active_date, r.closed_date) for r in got} == want
