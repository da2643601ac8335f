import datetime as dt
import random

import numpy as np
import pytest

from ledgerloom.llm import linkage as L
from ledgerloom.llm.linkage import LabelModel, Linkage, city_vote, edits, email_vote, matches, name_parts, name_votes
from ledgerloom.storage import materialize

PROFILE = "id string, op string, name string, birth string, city string, postcode string, email string, phone string, since date"
EVENT = "id string, op string, kind string, amount decimal(18,4), at long"


def test_values():
    assert name_parts("Linaovar, Bovil") == ("bovil", "linaovar") == name_parts("bovil M. LINAOVAR") == name_parts("Bóvil Linàovar")
    assert name_parts(None) == ("", "") == name_parts("77")
    assert name_votes(("d", "kisiidze"), name_parts("Davem Kiisiidze")) == (1, 0)
    assert name_votes(name_parts("bevolnekiulu73"), name_parts("Bevol Nekiulu")) == (1, 1)
    assert name_votes(name_parts("Some Body"), name_parts("Bevol Nekiulu")) == (-1, -1)
    assert edits("mosir", "msoir") == 1 and edits("abcdef", "ghijkl", 2) == 3 and edits("", "ab") == 2
    assert email_vote("se*****@postbox.example", "sesa@postbox.example") == 1 and email_vote("l***u@mail.example", "lx@mail.example") == -1 and email_vote(None, "a@b") == 0
    assert email_vote("a***b@x.example", "ab@y.example") == -1 and email_vote("n*4@z.example", "nar4@z.example") == 1
    assert city_vote("Quil.", "Quillstad") == 1 and city_vote("KAROBRUK", "Karobruk") == 1 and city_vote("Dovumouth", "Lindola") == -1


def test_model_learns_accuracies_and_correlation():
    rng = np.random.default_rng(3)
    y = rng.random(20_000) < 0.3
    good = np.where(rng.random(20_000) < 0.95, np.where(y, 1, -1), np.where(y, -1, 1))
    weak = [np.where(rng.random(20_000) < 0.7, np.where(y, 1, -1), np.where(y, -1, 1)) for _ in range(3)]
    copied = np.where(rng.random(20_000) < 0.98, weak[0], -weak[0])  # the same opinion twice
    silent = np.where(rng.random(20_000) < 0.6, 0, good)
    votes = np.stack([good, *weak, copied, silent], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = LabelModel().fit(patterns, counts)
    p = model.posterior(votes)
    assert ((p > 0.5) == y).mean() > 0.94
    assert model.parent[4] == 1 or model.parent[1] == 4


def world(n, seed):
    rng, day = random.Random(seed), dt.date(2024, 1, 1)
    a, u, ae, ue, truth = [], [], [], [], set()
    for k in range(n):
        first, last = "".join(rng.choice("aeioubdgklmnrstvz") for _ in range(5)), "".join(rng.choice("aeioubdgklmnrstvz") for _ in range(8))
        year, city, post = rng.randrange(1950, 2005), f"City{rng.randrange(40)}", str(rng.randrange(10000, 99999))
        aid, uid = f"21{rng.randrange(10**9):010d}", f"U{k:06d}"
        lone = rng.random()
        if lone > 0.1:
            name = rng.choice([f"{first} {last}", f"{last}, {first}", f"{first[0]}. {last}", None])
            a.append((aid, "op", name, rng.choice([str(year), f"01.02.{year}", None]), rng.choice([city, city.upper(), None]), rng.choice([post, None]), None, None, day))
            ae += [(aid, "op", "x", 1, 1000 * k * 50 + 977 * e) for e in range(rng.choice([1, 4, 6]))]
        if lone < 0.9:
            u.append((uid, rng.choice(["op", None]), f"{first} {last}", rng.choice([str(year), None]), rng.choice([city, None]), rng.choice([post, None]), None, rng.choice([aid[-4:], None]), day + dt.timedelta(days=rng.randrange(9))))
            ue += [(uid, "op", "x", 1, 1000 * k * 50 + 977 * e + rng.randrange(-5, 6)) for e in range(rng.choice([1, 4, 6]))]
        if 0.1 < lone < 0.9:
            truth.add((aid, uid))
    return a, u, ae, ue, truth


def link(spark, a, u, ae, ue):
    old = spark.createDataFrame([], "a_id string, u_id string")
    from pyspark.sql import functions as F

    ev = lambda rows: spark.createDataFrame([(i, o, k, str(m), t) for i, o, k, m, t in rows], EVENT.replace("decimal(18,4)", "string")).withColumn("amount", F.col("amount").cast("decimal(18,4)"))
    return Linkage(spark.createDataFrame(a, PROFILE), spark.createDataFrame(u, PROFILE), ev(ae), ev(ue), old)


def test_links_made_people(spark):
    a, u, ae, ue, truth = world(400, 1)
    a.append(a[0])  # repeated rows count once
    got = {(r.a_id, r.u_id) for r in matches(materialize(link(spark, a, u, ae, ue).votes(), "v")).collect()}
    assert len(got & truth) >= 0.97 * len(truth) and len(got - truth) <= 0.03 * len(got)


@pytest.mark.parametrize("which", [0, 1, 2])
def test_empty_sides(spark, which):
    a, u, ae, ue, _ = world(20, 2)
    parts = [([], u, [], ue), (a, [], ae, []), ([], [], [], [])][which]
    assert matches(link(spark, *parts).votes()).count() == 0


def test_blocks_need_no_profile(spark):
    a = [("21000000001", None, None, None, None, None, None, None, None)]
    u = [("U1", None, None, None, None, None, None, None, None)]
    events = [("21000000001", "o", "x", 1, t) for t in range(0, 90000, 9000)]
    linkage = link(spark, a, u, events, [("U1", *e[1:]) for e in events])
    assert linkage.votes().count() == 1
    assert L.FUNCTIONS[0] == "events_many"
