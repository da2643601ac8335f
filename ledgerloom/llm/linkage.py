"""Matching entities without a common key: a label model over many heuristic votes.

Candidates come from selective blocks: events of both sides that agree in everything recorded and lie seconds apart,
and keys built of several profile attributes. Each matching function votes on a candidate: 1 (same), -1 (different) or 0
(abstains). A generative model of the votes given the unknown truth is learnt by expectation maximisation: how often
each function votes right, wrong or not at all under either truth, and which functions are correlated, as a tree of
dependencies (Chow-Liu, by mutual information within the classes). It gives each candidate its posterior confidence. An
account is matched to its most probable user, if that is more probable than not.

Defined results: a NULL attribute makes its functions abstain and builds no block; repeated profile rows count once; ties
in confidence go to the candidate with more common events, then to the smallest user id; no candidates, no matches.

Scale: blocks join on keys of several attributes, never on one; common events are counted with map-side aggregation and
a hot account is spread over its event times. The model sees only counts by vote pattern (at most 3 ** number of
functions, 177,147 rows, independent of the data), and its table of posteriors is of the same bounded size.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FUNCTIONS = ("events_many", "events_any", "last_name", "first_name", "birth_year", "city", "postcode", "email", "phone", "joined", "old_link")
#: Seconds by which two records of one event may differ.
EVENT_SECONDS = 15


# ------------------------------------------------------------------------------------------------------ profile values
def folded(text: str | None) -> str:
    if not text:
        return ""
    text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return text.replace("ı", "i").lower().strip()


def name_parts(name: str | None) -> tuple[str, str]:
    """First and last name; a user name without blanks is all 'first' and has an empty last name."""
    text = re.sub(r"[0-9_]+", "", folded(name))
    if "," in text:
        last, _, first = text.partition(",")
        words = first.split()
        return (re.sub("[^a-z]", "", words[0]) if words else ""), re.sub("[^a-z]", "", last)
    words = [re.sub("[^a-z]", "", w) for w in text.split()]
    words = [w for w in words if w]
    if not words:
        return "", ""
    return words[0], (words[-1] if len(words) > 1 else "")


def joined_name(first: str, last: str) -> str:
    return first + last


def birth_year(text) -> int | None:
    found = re.search(r"(19|20)\d{2}", str(text)) if text is not None else None
    return int(found[0]) if found else None


def edits(a: str, b: str, most: int = 3) -> int:
    """Edit distance with transpositions, cut off above ``most``."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    two, one = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            best = min(one[j] + 1, row[-1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, two[j - 2] + 1)
            row.append(best)
        two, one = one, row
        if min(one) > most:
            return most + 1
    return one[-1]


def same_word(a: str, b: str) -> int:
    """1 if spelled alike (initials count as alike), -1 if not, 0 if unknown or only an initial is known to agree."""
    if not a or not b:
        return 0
    if len(a) == 1 or len(b) == 1:
        return 0 if a[0] == b[0] else -1
    if a == b:
        return 1
    allowed = 2 if min(len(a), len(b)) >= 7 else 1
    return 1 if edits(a, b, allowed) <= allowed else -1


def name_votes(a: tuple[str, str], b: tuple[str, str]) -> tuple[int, int]:
    """Votes on last and first names; a user name is compared with the joined names."""
    if not (a[0] or a[1]) or not (b[0] or b[1]):
        return 0, 0
    if not a[1] or not b[1]:
        whole_a, whole_b = joined_name(*a), joined_name(*b)
        if min(len(whole_a), len(whole_b)) < 4:
            return 0, 0
        alike = edits(whole_a, whole_b, 2) <= 2
        if not alike and min(len(a[0]), len(b[0])) >= 4 and (not a[1]) != (not b[1]):
            one, other = (a[0], b) if not a[1] else (b[0], a)
            alike = len(other[1]) > 3 and (one.endswith(other[1]) or one.startswith(other[1])) and other[0][:1] in (one[0], "")
        return (1, 1) if alike else (-1, -1)
    last, first = same_word(a[1], b[1]), same_word(a[0], b[0])
    if last < 0 and first < 0 and same_word(a[0], b[1]) > 0 and same_word(a[1], b[0]) > 0:
        return 1, 1
    return last, first


def email_vote(a: str | None, b: str | None) -> int:
    """Addresses may be masked by stars on one side."""
    a, b = folded(a), folded(b)
    if "@" not in a or "@" not in b:
        return 0
    (la, da), (lb, db) = a.rsplit("@", 1), b.rsplit("@", 1)
    if da != db:
        return -1
    if "*" in la or "*" in lb:
        masked, full = (la, lb) if "*" in la else (lb, la)
        head, tail = masked.split("*")[0], masked.rsplit("*", 1)[1]
        return 1 if full.startswith(head) and full.endswith(tail) else -1
    return 1 if edits(la, lb, 2) <= 2 else -1


def city_vote(a: str | None, b: str | None) -> int:
    a, b = folded(a), folded(b)
    if not a or not b:
        return 0
    if a.endswith(".") or b.endswith("."):
        short, full = (a[:-1], b) if a.endswith(".") else (b[:-1], a)
        return 1 if full.startswith(short) else -1
    return 1 if edits(a, b, 2) <= 2 else -1


def pair_votes(p: dict) -> list[int]:
    """The votes on one candidate, in the order of ``FUNCTIONS``."""
    common = p["common"] or 0
    a, b = name_parts(p["a_name"]), name_parts(p["u_name"])
    last, first = name_votes(a, b)
    ya, yu = birth_year(p["a_birth"]), p["u_birth"]
    yu = None if yu is None or yu != yu else int(yu)
    birth = 0 if ya is None or yu is None else (1 if ya == yu else (0 if abs(ya - yu) == 1 else -1))
    pa, pu = folded(p["a_postcode"]), folded(p["u_postcode"])
    post = 0 if not pa or not pu else (1 if pa == pu else (0 if edits(pa, pu, 1) <= 1 else -1))
    tail = folded(p["u_phone"])
    phone = 0 if not tail else (1 if str(p["a_id"]).endswith(tail) else -1)
    near = p["days"]
    joined = 0 if near is None or near != near else (1 if abs(near) <= 31 else -1)
    if p["a_op"] and p["u_op"] and p["a_op"] != p["u_op"]:
        joined = -1
    quiet = min(p["a_events"] or 0, p["u_events"] or 0)
    many = 1 if common >= 3 else (-1 if common == 0 and quiet >= 3 else 0)
    some = 1 if common >= 1 else (-1 if quiet >= 1 else 0)
    return [many, some, last, first, birth, city_vote(p["a_city"], p["u_city"]), post, email_vote(p["a_email"], p["u_email"]), phone, joined, 1 if p["old"] else 0]


def _vote_batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        pdf = pdf.astype(object).where(pdf.notna(), None)
        votes = [pair_votes(p) for p in pdf.to_dict("records")]
        out = pd.DataFrame(votes, columns=list(FUNCTIONS), index=pdf.index).astype("int32") if votes else pd.DataFrame(columns=list(FUNCTIONS)).astype("int32")
        out["a_id"], out["u_id"], out["common"] = pdf["a_id"], pdf["u_id"], pd.to_numeric(pdf["common"]).fillna(0).astype("int64")
        yield out


# --------------------------------------------------------------------------------------------------------- label model
@dataclass
class LabelModel:
    """Votes given the truth, factored along a tree: P(y) * product of P(vote i | vote of its parent, y)."""

    rounds: int = 60
    smoothing: float = 0.5
    prior: float = 0.5
    parent: list[int] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)  # [y, parent's vote, vote]

    def fit(self, votes: np.ndarray, counts: np.ndarray) -> LabelModel:
        """``votes``: distinct patterns (rows) of votes -1, 0, 1; ``counts``: how many candidates show each."""
        v, n = votes.astype(int) + 1, counts.astype(float)
        self.parent = [-1] * v.shape[1]
        margin = votes.sum(axis=1)
        q = 1 / (1 + np.exp(-1.5 * (margin - 0.2 * v.shape[1])))
        for k in range(self.rounds):
            # The first tree comes of the plain vote: functions that copy each other must not find a truth of their own.
            if k % (self.rounds // 4) == 0:
                self.parent = self._tree(v, n, q)
            self._maximise(v, n, q)
            q = self._posterior(v)
        return self

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return self._posterior(votes.astype(int) + 1)

    def _maximise(self, v: np.ndarray, n: np.ndarray, q: np.ndarray) -> None:
        self.prior = float(np.clip((n * q).sum() / n.sum(), 1e-6, 1 - 1e-6))
        self.tables = []
        for i, p in enumerate(self.parent):
            of = v[:, p] if p >= 0 else np.zeros(len(v), dtype=int)
            table = np.full((2, 3, 3), self.smoothing)
            np.add.at(table[1], (of, v[:, i]), n * q)
            np.add.at(table[0], (of, v[:, i]), n * (1 - q))
            self.tables.append(table / table.sum(axis=2, keepdims=True))

    def _posterior(self, v: np.ndarray) -> np.ndarray:
        log = np.stack([np.full(len(v), np.log(1 - self.prior)), np.full(len(v), np.log(self.prior))])
        for i, p in enumerate(self.parent):
            of = v[:, p] if p >= 0 else np.zeros(len(v), dtype=int)
            log += np.log(self.tables[i][:, of, v[:, i]])
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))

    def _tree(self, v: np.ndarray, n: np.ndarray, q: np.ndarray) -> list[int]:
        """Maximum spanning tree of the information that two functions share within the classes."""
        m = v.shape[1]
        shared = np.zeros((m, m))
        for w in (n * q, n * (1 - q)):
            for i in range(m):
                for j in range(i):
                    t = np.full((3, 3), 1e-9)
                    np.add.at(t, (v[:, i], v[:, j]), w)
                    t /= t.sum()
                    shared[i, j] += w.sum() * (t * np.log(t / (t.sum(1, keepdims=True) * t.sum(0, keepdims=True)))).sum()
        shared = (shared + shared.T) / n.sum()
        parent, inside = [-1] * m, {0}
        while len(inside) < m:
            i, j = max(((i, j) for i in range(m) if i not in inside for j in inside), key=lambda e: shared[e])
            parent[i] = j
            inside.add(i)
        return parent


# --------------------------------------------------------------------------------------------------------------- Spark
def common_events(a: DataFrame, u: DataFrame) -> DataFrame:
    """a_id, u_id, common: events of both sides that agree in block (any columns of the same names) and nearly in time.

    ``a``: a_id, blocks..., at (seconds); ``u``: u_id, the same blocks, at."""
    blocks = [c for c in a.columns if c not in ("a_id", "at")]
    width = EVENT_SECONDS + 1
    left = a.dropna().distinct().withColumn("slot", F.explode(F.array(*[F.floor(F.col("at") / width) + F.lit(k) for k in (-1, 0, 1)])))
    right = u.dropna().distinct().withColumn("slot", F.floor(F.col("at") / width)).withColumnRenamed("at", "u_at")
    met = left.join(right, [*blocks, "slot"]).where(F.abs(F.col("at") - F.col("u_at")) <= EVENT_SECONDS)
    return met.groupBy("a_id", "u_id").agg(F.count_distinct("at").alias("common"))


def _block_keys(side: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            pdf = pdf.astype(object).where(pdf.notna(), None)
            out = []
            for r in pdf.to_dict("records"):
                first, last = name_parts(r["name"])
                year = birth_year(r["birth"])
                city, post = folded(r["city"])[:4], folded(r["postcode"])
                tail = folded(r["phone"]) if side == "u" else str(r["id"])[-4:]
                email = folded(r["email"])
                whole = joined_name(first, last)
                keys = []
                if len(whole) > 5 and len(first) != 1:
                    keys.append(f"n|{whole}")
                if len(last) > 3 and year:
                    keys.append(f"s|{last}|{year}")
                if len(first) > 2 and last and year and city:
                    keys.append(f"f|{first}|{year}|{city}")
                if post and year:
                    keys.append(f"p|{post}|{year}")
                if "@" in email and "*" not in email:
                    keys.append(f"e|{email}")
                if tail and year:
                    keys.append(f"t|{tail}|{year}")
                if tail and len(last) > 2:
                    keys.append(f"l|{tail}|{last[:3]}")
                if post and len(last) > 2:
                    keys.append(f"q|{post}|{last}")
                # Short names say less, so they go with more beside them.
                if 0 < len(whole) <= 5 and year:
                    keys.append(f"n|{whole}|{year}")
                if 0 < len(last) <= 3 and year and city:
                    keys.append(f"s|{last}|{year}|{city}")
                if 0 < len(last) <= 2 and tail:
                    keys.append(f"l|{tail}|{last}|")
                if 0 < len(last) <= 2 and post and year:
                    keys.append(f"q|{post}|{last}|{year}")
                out += [(r["id"], k) for k in keys]
            yield pd.DataFrame(out, columns=["id", "key"])

    return run


def _keys(profile: DataFrame, side: str) -> DataFrame:
    return profile.mapInPandas(_block_keys(side), "id string, key string").withColumnRenamed("id", f"{side}_id").distinct()


@dataclass(frozen=True)
class Linkage:
    """Two registers and their events, under common names.

    Profiles: id, op, name, birth, city, postcode, email, phone, since (date). Events: id, op, kind, amount, at (seconds).
    ``old_links``: a_id, u_id of earlier, doubtful results; hints only."""

    a_profile: DataFrame
    u_profile: DataFrame
    a_events: DataFrame
    u_events: DataFrame
    old_links: DataFrame

    def candidates(self) -> DataFrame:
        """Every candidate with both profiles, common events, activity and old links."""
        a, u = self.a_profile.dropDuplicates(["id"]), self.u_profile.dropDuplicates(["id"])
        ae = self.a_events.withColumnRenamed("id", "a_id").distinct()
        ue = self.u_events.withColumnRenamed("id", "u_id").distinct()
        met = common_events(ae, ue)
        by_key = _keys(a, "a").join(_keys(u, "u"), "key").select("a_id", "u_id")
        old = self.old_links.select("a_id", "u_id", F.lit(1).alias("old"))
        pairs = met.select("a_id", "u_id", "common", F.lit(0).alias("old"))
        pairs = pairs.unionByName(by_key.select("a_id", "u_id", F.lit(0).cast("long").alias("common"), F.lit(0).alias("old")))
        pairs = pairs.unionByName(old.select("a_id", "u_id", F.lit(0).cast("long").alias("common"), "old"))
        pairs = pairs.groupBy("a_id", "u_id").agg(F.max("common").alias("common"), F.max("old").alias("old"))
        a_count = ae.groupBy("a_id").agg(F.count_distinct("at").alias("a_events"))
        u_count = ue.groupBy("u_id").agg(F.count_distinct("at").alias("u_events"))
        a = a.select(F.col("id").alias("a_id"), *[F.col(c).alias(f"a_{c}") for c in a.columns if c != "id"]).join(a_count, "a_id", "left")
        u = u.select(F.col("id").alias("u_id"), *[F.col(c).alias(f"u_{c}") for c in u.columns if c != "id"]).join(u_count, "u_id", "left")
        full = pairs.join(a, "a_id").join(u, "u_id")
        return full.withColumn("days", F.date_diff("u_since", "a_since")).drop("a_since", "u_since", "a_phone")

    def votes(self) -> DataFrame:
        schema = ", ".join(f"{f} int" for f in FUNCTIONS) + ", a_id string, u_id string, common bigint"
        return self.candidates().mapInPandas(_vote_batches, schema)


def matches(votes: DataFrame, least: float = 0.5) -> DataFrame:
    """account and user with the posterior confidence of the match, from a (materialised) table of votes."""
    counted = votes.groupBy(*FUNCTIONS).count().toPandas()
    spark = votes.sparkSession
    if not len(counted):
        return spark.createDataFrame([], "a_id string, u_id string, confidence double")
    patterns = counted[list(FUNCTIONS)].to_numpy()
    counted["confidence"] = LabelModel().fit(patterns, counted["count"].to_numpy()).posterior(patterns)
    schema = ", ".join(f"{f} int" for f in FUNCTIONS) + ", confidence double"
    table = spark.createDataFrame(counted[[*FUNCTIONS, "confidence"]], schema)  # bounded by 3 ** functions
    judged = votes.join(F.broadcast(table), list(FUNCTIONS)).where(F.col("confidence") >= least)
    best = Window.partitionBy("a_id").orderBy(F.col("confidence").desc(), F.col("common").desc(), "u_id")
    return judged.withColumn("rank", F.row_number().over(best)).where("rank = 1").select("a_id", "u_id", "confidence")
