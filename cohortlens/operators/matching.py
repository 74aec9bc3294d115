"""Request × patient matching on any schema.

Requests are reduced to *signatures*: the clauses they state that the patient
table can answer, and an age range. Clauses whose column is absent are skipped,
as in ``cohort.cohort_predicate``: gender from Sex, male or gender (text M/F or
male/female), age from Age or age (any number), conditions and severity from
their columns.

Patients are range-partitioned by id into parts of about ``PART_ROWS`` rows and
packed, in id order, into blocks of ``block_rows``: one bit array per clause
value, the ages and the ids. A signature's matches in a block are the AND of its
clauses' bits; the ages of those rows, sorted once per set of clauses, give the
count for every age range by two binary searches.

1. Every part counts all signatures: one row per (signature, part) with a match.
2. Running sums over a signature's parts tell which parts hold its first n
   matches, n the most any of its requests wants, and how many each gives.
3. Only those parts are read again and return the ids with their ranks.
4. Requests take the ranks they want from their signature.

No patient row is joined with a request before it is known to be delivered, no
part or block count is capped, and requests that say the same are searched once.
Signatures travel with the tasks, at most ``SIGNATURES`` at a time; more of them
take more passes.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.operators.requests import CONDITION_COLUMNS

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PART_ROWS = 1 << 16
SIGNATURES = 50_000
MOST_VALUES = 64         # distinct genders or severities that requests may ask for


def _asked(requests: DataFrame, col: str) -> list:
    rows = requests.where(F.col(col).isNotNull()).select(col).distinct().limit(MOST_VALUES + 1).collect()
    if len(rows) > MOST_VALUES:
        raise ValueError(f"{col}: more than {MOST_VALUES} distinct values asked for")
    return sorted(r[0] for r in rows)


def clauses_of(requests: DataFrame, patients: DataFrame) -> list[tuple[Column, Column]]:
    """(condition on a patient, condition on a request that states it) of every
    clause that some request may state and the patient table can answer."""
    cols, out = set(patients.columns), []
    gender = next((c for c in ("Sex", "male", "gender") if c in cols), None)
    if gender:
        for v in _asked(requests, "gender"):
            is_ = F.upper(gender).isin(["M", "MALE"] if v == 1 else ["F", "FEMALE"]) if gender == "gender" else F.col(gender) == F.lit(v)
            out.append((is_, F.col("gender") == F.lit(v)))
    for name, col in CONDITION_COLUMNS.items():
        if col in cols:
            out.append((F.col(col) >= 1 if name == "diabetes" else F.col(col) == 1, F.array_contains("conditions", name)))
    if "Diabetes_Target" in cols:
        out += [(F.col("Diabetes_Target") == F.lit(v), F.col("severity_target") == F.lit(v)) for v in _asked(requests, "severity_target")]
    return out


def _signed(requests: DataFrame, clauses: list, age: str | None) -> DataFrame:
    """(request_id, n_req, sig, bits, lo, hi) of every request."""
    stated = F.array(*[F.when(F.coalesce(says, F.lit(False)), F.lit(i)) for i, (_, says) in enumerate(clauses)]) if clauses \
        else F.array().cast("array<int>")
    lo, hi = ((F.col(c).cast("double") if age else F.lit(None).cast("double")) for c in ("age_min", "age_max"))
    r = requests.select("request_id", F.col("num_patients").alias("n_req"), F.array_compact(stated).alias("bits"), lo.alias("lo"), hi.alias("hi"))
    text = F.concat_ws("|", F.array_join("bits", ","), F.coalesce(F.col("lo").cast("string"), F.lit("")), F.coalesce(F.col("hi").cast("string"), F.lit("")))
    return r.withColumn("sig", text)


def _packed(patients: DataFrame, clauses: list, id_col: str, age: str | None, block_rows: int) -> DataFrame:
    """(part, at, ids, ages, bits): blocks in id order, bits = one packed bit
    array per clause, one after the other."""
    m = len(clauses)
    rows = patients.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), (F.col(age).cast("double") if age else F.lit(None).cast("double")).alias("age"),
        *[F.coalesce(is_, F.lit(False)).alias(f"c{i}") for i, (is_, _) in enumerate(clauses)])
    parts = max(1, -(-rows.count() // PART_ROWS))
    rows = rows.repartitionByRange(parts, "id").sortWithinPartitions("id").withColumn("part", F.spark_partition_id())

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, rest = 0, None
        for f in _then_none(frames):
            rest = f if rest is None else rest if f is None else pd.concat([rest, f], ignore_index=True)
            while rest is not None and len(rest) >= (block_rows if f is not None else 1):
                b, rest = rest.iloc[:block_rows], rest.iloc[block_rows:].reset_index(drop=True)
                bits = b"".join(np.packbits(b[f"c{i}"].to_numpy(bool)).tobytes() for i in range(m))
                yield pd.DataFrame({"part": [int(b["part"].iloc[0])], "at": [at], "ids": [b["id"].tolist()],
                                    "ages": [b["age"].to_numpy(float).tobytes()], "bits": [bits]})
                at += 1

    kind = rows.schema["id"].dataType.simpleString()
    from cohortlens.operators.privacy import materialize
    return materialize(rows.mapInPandas(pack, f"part int, at int, ids array<{kind}>, ages binary, bits binary"))


def _then_none(frames: Iterator) -> Iterator:
    yield from frames
    yield None


class Block:
    """Bit arrays and ages of one block; matching rows per set of clauses."""

    def __init__(self, ages: bytes, bits: bytes):
        self.ages = np.frombuffer(ages)
        n = len(self.ages)
        self.bits = np.frombuffer(bits, np.uint8).reshape(-1, -(-n // 8)) if bits else np.zeros((0, -(-n // 8)), np.uint8)

    def rows(self, stated: tuple) -> np.ndarray:
        """Mask of the rows that meet all ``stated`` clauses."""
        packed = np.bitwise_and.reduce(self.bits[list(stated)], axis=0) if stated else np.full(self.bits.shape[1], 255, np.uint8)
        return np.unpackbits(packed, count=len(self.ages)).astype(bool)

    def counts(self, stated: tuple, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Matches per age range; a range without ends (NaN, NaN) takes all."""
        on = self.rows(stated)
        ages = np.sort(self.ages[on & ~np.isnan(self.ages)])
        first = np.where(np.isnan(lo), 0, np.searchsorted(ages, np.nan_to_num(lo)))
        last = np.where(np.isnan(hi), len(ages), np.searchsorted(ages, np.nan_to_num(hi), side="right"))
        return np.where(np.isnan(lo) & np.isnan(hi), int(on.sum()), np.maximum(last - first, 0))

    def places(self, stated: tuple, lo: float, hi: float) -> np.ndarray:
        on = self.rows(stated)
        with np.errstate(invalid="ignore"):
            on = on if np.isnan(lo) else on & (self.ages >= lo)
            on = on if np.isnan(hi) else on & (self.ages <= hi)
        return np.flatnonzero(on)


def match_cohorts(requests: DataFrame, patients: DataFrame, id_col: str = "patient_id", age_col: str | None = None,
                  block_rows: int = 4096, with_counts: bool = False) -> DataFrame:
    """For every normalised request (request_id, num_patients, gender, age_min,
    age_max, conditions, severity_target): the ``num_patients`` matching patients
    with the smallest ids → (request_id, patient_id, rank). With
    ``with_counts``: (request_id, requested, matched, delivered) instead."""
    from cohortlens.operators.privacy import materialize, reuse
    age = age_col or next((c for c in ("Age", "age") if c in patients.columns), None)
    clauses = clauses_of(requests, patients)
    signed = reuse(_signed(requests, clauses, age))
    sigs = reuse(signed.groupBy("sig", "bits", "lo", "hi").agg(F.max("n_req").alias("most")))
    passes = max(1, -(-sigs.count() // SIGNATURES))
    sigs = sigs.withColumn("pass", F.pmod(F.xxhash64("sig"), F.lit(passes)).cast("int"))
    blocks = _packed(patients, clauses, id_col, age, block_rows)

    def counted(number: int) -> DataFrame:
        rows = sigs.where(F.col("pass") == number).select("sig", "bits", "lo", "hi").collect()
        names = np.array([r["sig"] for r in rows], object)
        nan = float("nan")
        lo, hi = (np.array([nan if r[c] is None else r[c] for r in rows]) for c in ("lo", "hi"))
        sets: dict[tuple, list[int]] = {}
        for i, r in enumerate(rows):
            sets.setdefault(tuple(r["bits"]), []).append(i)

        def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total: dict[int, np.ndarray] = {}
            for f in frames:
                for r in f.itertuples():
                    block, m = Block(r.ages, r.bits), total.setdefault(r.part, np.zeros(len(names), np.int64))
                    for stated, at in sets.items():
                        m[at] += block.counts(stated, lo[at], hi[at])
            for part, m in total.items():
                hit = np.flatnonzero(m)
                if not len(hit):
                    continue
                yield pd.DataFrame({"sig": names[hit], "part": np.full(len(hit), part, np.int32), "m": m[hit]})

        return blocks.select("part", "ages", "bits").mapInPandas(count, "sig string, part int, m long")

    parts = counted(0)
    for number in range(1, passes):
        parts = parts.unionByName(counted(number))
    # a part's blocks may lie in several read tasks
    parts = materialize(parts.groupBy("sig", "part").agg(F.sum("m").alias("m")))
    if with_counts:
        matched = parts.groupBy("sig").agg(F.sum("m").alias("matched"))
        got = F.coalesce("matched", F.lit(0)).cast("bigint")
        return signed.join(matched, "sig", "left").select("request_id", F.col("n_req").alias("requested"), got.alias("matched"),
                                                          F.least(F.col("n_req").cast("bigint"), got).alias("delivered"))
    before = F.sum("m").over(Window.partitionBy("sig").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("m")
    need = (parts.withColumn("before", before).join(sigs, "sig").where(F.col("before") < F.col("most"))
            .select("part", "pass", "sig", "bits", "lo", "hi", "before", F.least(F.col("m"), F.col("most") - F.col("before")).alias("take")))
    kind = patients.schema[id_col].dataType.simpleString()

    def deliver(held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        held = held.sort_values("at")
        opened = [(Block(r.ages, r.bits), np.array(r.ids, object)) for r in held.itertuples()]
        out = {"sig": [], "id": [], "rank": []}
        for q in asked.itertuples():
            lo, hi = (float("nan") if x is None else x for x in (q.lo, q.hi))
            left, rank = int(q.take), int(q.before)
            for block, ids in opened:
                if not left:
                    break
                some = ids[block.places(tuple(q.bits), lo, hi)[:left]]
                out["sig"] += [q.sig] * len(some)
                out["id"] += some.tolist()
                out["rank"] += range(rank + 1, rank + 1 + len(some))
                rank, left = rank + len(some), left - len(some)
        return pd.DataFrame(out)

    wide = (blocks.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
            .join(need.select("part", "pass").distinct(), ["part", "pass"], "left_semi"))
    picked = (wide.groupBy("part", "pass").cogroup(need.groupBy("part", "pass"))
              .applyInPandas(deliver, f"sig string, id {kind}, rank int"))
    return (signed.select("request_id", "n_req", "sig").join(picked, "sig").where(F.col("rank") <= F.col("n_req"))
            .select("request_id", F.col("id").alias(id_col), "rank"))
