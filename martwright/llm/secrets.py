"""Secret scan with corpus-wide ownership frequency.

Base patterns give spans that always stay. A wider pattern gives candidates:
long tokens of mixed letters and digits with high entropy, outside base spans.
Every value is hashed, and the distinct repositories and owners that hold it are
counted over the whole corpus: a value with many owners is a copied example, one
that few owners hold looks live. Live candidates become spans of their own; base
spans carry the same verdict.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.bloom import split_rows
from martwright.llm.text import canonical, documents, packed, store, text_slices, tidy, unpacked

#: Fixed kinds and patterns, in the order in which spans of one start are listed.
KINDS = ["assign", "access", "hex", "owned"]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16
MIN_BITS = 3.5
#: At most so many distinct owners, and repositories, hold a live-looking value.
LIVE_OWNERS, LIVE_REPOSITORIES = 2, 4

#: A text that none of these matches has no span; they only spare the slower engine.
_MAY_HOLD = (r"""(?i)(password|passwd|secret|token|api_?key)["']? *[:=]""", r"AKIA[A-Z0-9]{14}", r"[0-9a-f]{16}", r"[A-Za-z0-9+/_-]{20}")
_SCAN = ("doc_id long, row_key long, repository string, owner string, n_assign long, n_access long, n_hex long, base string, "
         "found array<struct<kind:int,start:int,stop:int,value:string>>")


def _entropy(value: str) -> float:
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, secret value), by start, then kind."""
    spans = [(0, m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    spans += [(1, m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    spans += [(2, m.start(), m.end(), m[0]) for m in HEX.finditer(text) if len(m[0]) >= MIN_HEX]
    return sorted(spans, key=lambda s: (s[1], s[0]))


def candidates(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Long mixed tokens of high entropy that touch no base span."""
    found = []
    for m in CANDIDATE.finditer(text):
        value = m[0]
        if (re.search(r"[0-9]", value) and re.search(r"[A-Za-z]", value) and _entropy(value) >= MIN_BITS
                and not any(s < m.end() and m.start() < e for _, s, e, _ in base)):
            found.append((3, m.start(), m.end(), value))
    return found


def listed(spans: list[tuple[int, int, int, str]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e, _ in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    empty = ((0, 0, 0), "", [])
    for batch in text_slices(batches):
        texts = batch.column("text")
        held = [pc.match_substring_regex(texts, p) for p in _MAY_HOLD]
        may = pc.or_(pc.or_(held[0], held[1]), pc.or_(held[2], held[3])).to_pylist()
        rows = []
        for i, hit in enumerate(may):
            if not hit:
                rows.append(empty)
                continue
            text = texts[i].as_py()
            base = base_spans(text)
            kinds = Counter(s[0] for s in base)
            found = [{"kind": k, "start": s, "stop": e, "value": hashlib.sha256(v.encode()).hexdigest()}
                     for k, s, e, v in base + candidates(text, base)]
            rows.append(((kinds[0], kinds[1], kinds[2]), listed(base), found))
        yield pa.RecordBatch.from_arrays([
            *(batch.column(c) for c in ("doc_id", "row_key", "repository", "owner")),
            *(pa.array([r[0][k] for r in rows], pa.int64()) for k in range(3)),
            pa.array([r[1] for r in rows], pa.string()),
            pa.array([r[2] for r in rows], pa.list_(pa.struct([
                ("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("value", pa.string())])))],
            names=["doc_id", "row_key", "repository", "owner", "n_assign", "n_access", "n_hex", "base", "found"])


def scan_secrets(docs: DataFrame, owner: str = "source", repository: tuple[str, ...] = ("source", "lang"),
                 live_owners: int = LIVE_OWNERS, live_repositories: int = LIVE_REPOSITORIES) -> DataFrame:
    """One row per document: doc_id, row_key, n_assign, n_access, n_hex, base,
    spans, and the span lists ``hidden`` (all spans, as structs), n_live and
    n_example (base and candidate values by verdict).

    Null and empty texts have no spans; null owners and repositories count as
    one; repeated rows hold equal spans and count once for their owner; an empty
    table gives an empty result; further input columns are ignored.
    """
    repo = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in repository])
    base = (canonical(docs, repo.alias("repository"), F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"))
            .withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("row_key", F.xxhash64("doc_id", "text")))
    scanned = store(base.select("doc_id", "row_key", "repository", "owner", "text").mapInArrow(tidy(_scan), _SCAN), "secrets")
    found = scanned.where(F.size("found") > 0).select("row_key", "repository", "owner", F.explode("found").alias("f"))
    # distinct holders first: a value copied into every row of an owner counts once
    holders = found.select(F.col("f.value").alias("value"), "repository", "owner").distinct()
    owned = (holders.groupBy("value", "owner").agg(F.count("*").alias("n"))
             .groupBy("value").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories")))
    judged = (found.select("row_key", "f.*").distinct().join(owned, "value")
              .withColumn("live", (F.col("owners") <= live_owners) & (F.col("repositories") <= live_repositories)))
    spans = (judged.groupBy("row_key").agg(
        F.sort_array(F.collect_set(F.when((F.col("kind") < 3) | F.col("live"), F.struct("start", "kind", "stop")))).alias("hidden"),
        F.sum(F.col("live").cast("long")).alias("n_live"), F.sum((~F.col("live")).cast("long")).alias("n_example")))
    names = F.array(*[F.lit(k) for k in KINDS])
    joined = F.concat_ws(",", F.transform("hidden", lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))))
    return scanned.join(spans, "row_key", "left").select(
        "doc_id", "row_key", "n_assign", "n_access", "n_hex", "base", F.coalesce(joined, F.lit("")).alias("spans"), "hidden",
        F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_example", F.lit(0)).alias("n_example"))


def mask_secrets(docs: DataFrame, **limits) -> DataFrame:
    """All documents, in their own columns, every span replaced by ``<secret>``.

    Null texts stay null; repeated rows are masked alike; an empty table gives an
    empty result; no name of another column clashes. Rows without a span are
    told by a filter of keys and are not shuffled.
    """
    hits = store(scan_secrets(docs, **limits).where(F.size("hidden") > 0).dropDuplicates(["row_key"])
                 .select(F.col("row_key").alias("key"), "hidden"), "hidden")
    # spans by start: what lies between the last end and this start is kept; overlaps are one mask
    text = F.col("_row.text")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    masked = F.aggregate(
        "hidden", start,
        lambda a, s: F.struct(
            F.concat(a["out"], F.when(s["start"] >= a["at"], F.concat(
                F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit("<secret>"))).otherwise(F.lit(""))).alias("out"),
            F.greatest(a["at"], s["stop"]).alias("at")),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.char_length(text))))
    keyed = packed(docs).withColumn("_id", F.xxhash64(F.col("_row.doc_id").cast("long"), F.coalesce(text, F.lit(""))))
    same, others = split_rows(keyed, "_id", hits.select("key"))
    out = others.join(hits, F.col("_id") == F.col("key"), "left").select(
        "_row", F.when(F.col("hidden").isNull(), text).otherwise(masked).alias("_text"))
    if same is not None:
        out = out.unionByName(same.select("_row", text.alias("_text")))
    return unpacked(out, F.col("_text"))


def op6_secret_scans(spark, sf_dir: str) -> DataFrame:
    return scan_secrets(documents(spark, sf_dir)).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_live", "n_example")
