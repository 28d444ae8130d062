"""Requests put together in streaming state: the same tables after any split of the files."""

import datetime as dt
import random

import pytest

from careledger.plans import facts
from careledger.schemas import TABLES
from careledger.sources.warehouse import Warehouse
from careledger.streaming.requests import complete, load_whole, merged
from tests.test_loads import NOON, got, landed, marks, units, value, values

LATER = NOON + dt.timedelta(hours=1)


def land(df, folder):
    df.coalesce(1).write.mode("append").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(folder)


def rows(wh):
    return got(wh.read("datavalues"), "orgunit", "dataelement", "value_double")


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_gives_the_tables_of_one_load(spark, tmp_path, seed):
    draw = random.Random(seed)
    answers = []
    for r in range(12):
        pages = draw.choice([1, 2, 3])
        for page in range(1, pages + 1):
            body = values(*(value(f"u{r}", element=f"e{page}{i}", value=str(draw.randrange(9))) for i in range(2)))
            if draw.random() < 0.2:
                answers.append((f"r{r}", f"u{r}", None, page, "error", NOON, pages))
            if draw.random() < 0.15:
                body = '{"dataValues": [{'
            answers.append((f"r{r}", f"u{r}", body, page, "ok", LATER, pages))
    ids = [f"u{r}" for r in range(12)]
    whole, split = (Warehouse(spark, str(tmp_path / n)) for n in ("whole", "split"))
    for wh in (whole, split):
        units(spark, wh, *ids)
    facts.load_values(whole, landed(spark, *answers), NOON)
    draw.shuffle(answers)
    folder = str(tmp_path / "landing")
    for start in (0, 7, 15):
        part = answers[start:{0: 7, 7: 15}.get(start)]
        if part:
            land(landed(spark, *part), folder)
            load_whole(split, folder, "values", NOON, facts.load_values, checkpoint=str(tmp_path / "progress"))
    assert rows(split) == rows(whole) and rows(whole) and marks(split) == marks(whole)


def test_what_stays_incomplete_goes_on_after_the_patience(spark, tmp_path):
    wh, folder = Warehouse(spark, str(tmp_path / "wh")), str(tmp_path / "landing")
    units(spark, wh, "u", "v")
    run = dict(patience=dt.timedelta(milliseconds=1), checkpoint=str(tmp_path / "progress"))
    land(landed(spark, ("r", "u", values(value("u")), 1, "ok", NOON, 2)), folder)
    load_whole(wh, folder, "values", NOON, facts.load_values, **run)
    assert not wh.exists("pending_datavalues")
    land(landed(spark, (None, "u", values(value("u"))), ("s", "v", values(value("v")))), folder)
    load_whole(wh, folder, "values", NOON, facts.load_values, **run)
    assert rows(wh) == [("v", "e", 1.0)]
    assert got(wh.read("pending_datavalues"), "request_id", "page") == [("r", 1)]
    assert wh.read("datavalues").columns == TABLES["datavalues"].schema.names


def test_rules():
    def answer(page, at, status="ok", responses=None, failed=False):
        return {"page": page, "fetched_at": at, "status": status, "responses": responses, "failed": failed}

    bad, good = answer(1, "b", "error", failed=True), answer(1, "b")
    assert merged([bad], [good]) == merged([good], [bad]) == [good]
    assert merged([answer(1, "a")], [bad]) == [bad] and len(merged([answer(None, "a")], [answer(None, "a")])) == 2
    assert complete([answer(None, "a")]) and complete([answer(1, "a", responses=2), answer(2, "a")])
    assert not complete([answer(1, "a", responses=2)]) and not complete([bad])
