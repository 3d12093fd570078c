"""The poll files that the checks land."""

from pathlib import Path

from checks.landing import DAY_S, land_files
from stopclock.sources.payloads import message_class


def test_a_task_writes_one_poll(spark):
    polls = spark.createDataFrame([(n * DAY_S, f"poll {n}") for n in range(19_000, 19_012)], "poll bigint, content string")
    folder = Path(land_files(spark, polls.coalesce(1), "landing-test").removesuffix("/poll=*"))
    files = list(folder.glob("poll=*/part-*.txt"))
    assert {int(f.parent.name[5:]) // DAY_S for f in files} == set(range(19_000, 19_012))
    tasks = {(f.parent.name, f.name[:10]) for f in files}
    assert len({t for _, t in tasks}) == len({p for p, _ in tasks}) == 12  # none holds two polls


def test_a_process_builds_the_message_class_once():
    assert message_class() is message_class()
