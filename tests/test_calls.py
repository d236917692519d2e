"""External calls whose attempts are kept: failures, restarts, dying tasks, answers of another number."""

import json
import os
import subprocess
import sys
import uuid

import pytest
from pyspark import cloudpickle

from collatio.operators import filters
from collatio.plans import ingest
from collatio.plans.calls import Calls, _made

# Workers don't import the tests, so their classes travel whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Counting:
    """Notes every call in a folder; fails as long as a text has been asked for fewer than `failures` times, or holds "bad"."""

    def __init__(self, folder, failures=0):
        self.folder, self.failures = str(folder), failures

    def translate(self, texts):
        before = sum(texts == asked for asked in calls_in(self.folder))
        with open(f"{self.folder}/{uuid.uuid4().hex}", "w") as f:
            json.dump(texts, f)
        if before < self.failures or any("bad" in t for t in texts):
            raise OSError("offline")
        return [t.upper() for t in texts]


class Dying(Counting):
    """Takes the process with it when it comes to a text."""

    def translate(self, texts):
        if "t77" in texts:
            os._exit(1)
        return super().translate(texts)


def calls_in(folder):
    found = []
    for name in os.listdir(folder):
        with open(f"{folder}/{name}") as f:
            content = f.read()
        if content:
            found.append(json.loads(content))
    return found


def texts_of(spark, n, *more):
    return spark.createDataFrame([(f"t{i}",) for i in range(n)] + [(m,) for m in more], "original string")


def asked_folder(tmp_path):
    (tmp_path / "asked").mkdir()
    return tmp_path / "asked"


def test_fails_twice_with_a_restart_between(spark, tmp_path):
    asked = asked_folder(tmp_path)
    first = Calls(spark, f"{tmp_path}/work", size=5, whole=3, wait=0.01, lanes=3)
    first.plan(texts_of(spark, 40, "", None, "t1"))
    assert first.round(Counting(asked, 2)) >= 8 and first.answers().count() == 0
    # Another object, as after a restart; planning again adds nothing.
    again = Calls(spark, f"{tmp_path}/work", size=5, whole=3, wait=0.01, lanes=3)
    again.plan(texts_of(spark, 40))
    again.run(Counting(asked, 2))
    assert {(r.original, r.written) for r in again.answers().collect()} == {(f"t{i}", f"T{i}") for i in range(40)}
    times = {}
    for texts in calls_in(asked):
        for t in texts:
            times[t] = times.get(t, 0) + 1
    assert set(times.values()) == {3}  # two failures and one answer, none asked for again
    n = len(calls_in(asked))
    again.run(Counting(asked))
    assert len(calls_in(asked)) == n and again.failed().count() == 0


def test_a_bad_text_takes_no_other_with_it(spark, tmp_path):
    asked = asked_folder(tmp_path)
    calls = Calls(spark, f"{tmp_path}/work", size=4, wait=0.01)
    calls.plan(texts_of(spark, 30, "bad", "ünbad🙂"))
    calls.run(Counting(asked))
    assert calls.answers().count() == 30
    assert sorted((r.original, r.attempts, r.error) for r in calls.failed().collect()) == [("bad", 3, "OSError: offline"), ("ünbad🙂", 3, "OSError: offline")]


def test_waits_double(spark, tmp_path):
    asked, now = asked_folder(tmp_path), 4e9
    calls = Calls(spark, f"{tmp_path}/work", size=1, tries=4, wait=100.0)
    calls.plan(texts_of(spark, 0, "bad"))
    waits = []
    for _ in range(3):
        assert calls.round(Counting(asked), now) == 1
        made = calls.attempts().agg({"at": "max"}).first()[0]
        waits.append(round(calls.state().first().due - made))
    assert waits == [100, 200, 400]
    assert calls.round(Counting(asked), made + 399) == 0


def test_what_a_dying_task_has_finished_is_not_asked_again(spark, tmp_path):
    asked = asked_folder(tmp_path)
    calls = Calls(spark, f"{tmp_path}/work", size=1, segment=1, lanes=1)
    calls.plan(texts_of(spark, 100))
    with pytest.raises(Exception):
        calls.round(Dying(asked))
    before = calls.answers().count()
    assert 0 < before < 100 and len(calls_in(asked)) == before
    calls.run(Counting(asked))
    assert calls.answers().count() == 100 and len(calls_in(asked)) == 100


def test_another_number_of_answers_is_a_failure(spark, tmp_path):
    class Short:
        def translate(self, texts):
            return texts[1:] if len(texts) > 1 else texts

    calls = Calls(spark, f"{tmp_path}/work", size=6, wait=0.01)
    calls.plan(texts_of(spark, 12))
    calls.run(Short())
    assert calls.answers().count() == 12 and "answers for" in calls.attempts().where("error is not null").first().error


def test_no_texts(spark, tmp_path):
    calls = Calls(spark, f"{tmp_path}/work")
    calls.plan(texts_of(spark, 0))
    calls.run(Counting(asked_folder(tmp_path)))
    assert calls.answers().collect() == [] and calls.failed().collect() == []


def test_columns_and_lists_use_earlier_answers(spark, tmp_path):
    asked = asked_folder(tmp_path)
    df = spark.createDataFrame([(1, "a", ["b", "", None]), (2, "bad", ["a"]), (3, None, None)], "id int, x string, l array<string>")
    calls = Calls(spark, f"{tmp_path}/work", wait=0.01)
    assert {r.id: (r.x, r.xJP) for r in ingest.translated_columns(df, ["x"], Counting(asked), calls=calls).collect()} == {1: ("A", "a"), 2: ("bad", "bad"), 3: (None, None)}
    assert {r.id: r.l for r in ingest.translated_lists(df, "id", ["l"], Counting(asked), calls=calls).collect()} == {1: ["B", "", None], 2: ["A"], 3: None}
    assert sum("a" in texts and "bad" not in texts for texts in calls_in(asked)) == 1


def test_reasons_split(spark):
    df = spark.createDataFrame([(1, "scrape_error"), (2, "no_url"), (3, None)], "id int, reason string")
    hit, rest = filters.split_by_reason(df, "reason", "scrape_error")
    assert [r.id for r in hit.collect()] == [1] and sorted(r.id for r in rest.collect()) == [2, 3]


def test_as_many_files_as_tasks(spark, tmp_path):
    asked = asked_folder(tmp_path)
    calls = Calls(spark, f"{tmp_path}/work", size=1, segment=1, lanes=3, wait=0.01)
    calls.plan(texts_of(spark, 90, "bad"))
    assert calls.round(Counting(asked)) == 91
    assert len(os.listdir(f"{tmp_path}/work/attempts")) == 3
    calls.run(Counting(asked))
    assert len(os.listdir(f"{tmp_path}/work/attempts")) == 5  # "bad" twice more
    assert calls.answers().count() == 90 and [r.attempts for r in calls.failed().collect()] == [3]


@pytest.mark.parametrize("kept", [0, 1, 40, 120, -2, -1])
def test_a_torn_line_is_asked_again_and_no_other(spark, tmp_path, kept):
    asked = asked_folder(tmp_path)
    calls = Calls(spark, f"{tmp_path}/work", size=1, lanes=1)
    calls.plan(texts_of(spark, 9, 'x"}]}\n🙂'))
    calls.round(Counting(asked))
    (name,) = os.listdir(f"{tmp_path}/work/attempts")
    with open(f"{tmp_path}/work/attempts/{name}") as f:
        lines = f.readlines()
    with open(f"{tmp_path}/work/attempts/{name}", "w") as f:
        f.writelines([*lines[:-1], lines[-1][:kept]])
    whole = kept == -1  # only the line end is missing
    again = Calls(spark, f"{tmp_path}/work", size=1, lanes=1)
    assert again.answers().count() == 9 + whole and len(_made(f"{tmp_path}/work/attempts", name)) == 9 + whole
    again.run(Counting(asked))
    assert len(calls_in(asked)) == 11 - whole and {r.original: r.written for r in again.answers().collect()} == {t: t.upper() for t in [*(f"t{i}" for i in range(9)), 'x"}]}\n🙂']}


def test_a_task_that_is_run_again_finds_what_it_has_finished(tmp_path):
    asked = asked_folder(tmp_path)
    script = f"""
import json, os, uuid
from pyspark.sql import SparkSession
from collatio.plans.calls import Calls

class DiesOnce:
    def translate(self, texts):
        with open(f"{asked}/{{uuid.uuid4().hex}}", "w") as f:
            json.dump(texts, f)
        if texts == ["t7"] and not os.path.exists("{tmp_path}/died"):
            open("{tmp_path}/died", "w").close()
            os._exit(1)
        return [t.upper() for t in texts]

spark = SparkSession.builder.master("local[1,3]").config("spark.ui.enabled", "false").getOrCreate()
calls = Calls(spark, "{tmp_path}/work", size=1, segment=4, lanes=1)
calls.plan(spark.createDataFrame([(f"t{{i}}",) for i in range(40)], "original string"))
assert calls.round(DiesOnce()) == 40
assert sorted(r.written for r in calls.answers().collect()) == sorted(f"T{{i}}" for i in range(40))
"""
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=180, cwd=os.path.dirname(os.path.dirname(__file__)))
    assert done.returncode == 0, done.stderr[-2000:]
    times = [t for texts in calls_in(asked) for t in texts]
    assert os.path.exists(tmp_path / "died") and len(set(times)) == 40 and times.count("t7") == 2 and len(times) <= 44
    assert len(os.listdir(tmp_path / "work" / "attempts")) == 2
