"""Secret scan with corpus-wide ownership frequency.

Patterns find candidates in every whole text. Each candidate's value is hashed,
and the hashes are counted over the whole corpus: in how many repositories and
under how many owners does it occur? A value that many owners share is a
widely copied example (documentation, fixtures); a value that stays with one or
few owners looks like a live credential.

Pattern spans are always reported, with that verdict. Loose candidates (long
mixed strings of high entropy) are reported only when they look live, which is
what the ownership counts decide.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import quoted, spill

EXAMPLE_OWNERS = 3  # a value under so many owners is an example
EXAMPLE_REPOS = 20  # and so is one in so many repositories, whoever owns them
LOOSE_ENTROPY = 4.0
LOOSE_LENGTH = 24
# the kinds in the order in which spans of one start are listed; the first
# three are the base kinds, "loose" candidates depend on the counts
KINDS = ("assign", "access", "hex", "jwt", "forge", "pem", "loose")
BASE_KINDS = KINDS[:3]

_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_CASED = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
                  for w in ("password", "passwd", "secret", "token")) + "|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
_ASSIGN = re.compile(rf"""({_CASED})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_JWT = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
_FORGE = re.compile(r"gh[pousr]_[A-Za-z0-9]{30,}")
_PEM = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----")
_LOOSE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LOOSE_LENGTH},}}")


def entropy(value: str) -> float:
    """Bits a character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def _mixed(value: str) -> bool:
    return (any(c.isdigit() for c in value) and any("a" <= c <= "z" for c in value)
            and any("A" <= c <= "Z" for c in value) and entropy(value) >= LOOSE_ENTROPY)


def find_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) by start, then kind as listed; code points,
    end exclusive. Leftmost non-overlapping for each kind; loose candidates
    that touch another span are left out."""
    found = []
    lowered = text.lower()
    if any(w in lowered for w in _WORDS):
        found += [("assign", *m.span(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [("access", *m.span(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [("hex", *m.span(), m[0]) for m in _HEX.finditer(text)]
    if "eyJ" in text:
        found += [("jwt", *m.span(), m[0]) for m in _JWT.finditer(text)]
    if "gh" in text:
        found += [("forge", *m.span(), m[0]) for m in _FORGE.finditer(text)]
    if "PRIVATE KEY-----" in text:
        found += [("pem", *m.span(), m[0]) for m in _PEM.finditer(text)]
    taken = sorted((s, e) for _, s, e, _ in found)
    at, reach = 0, 0
    for m in _LOOSE.finditer(text):
        if not _mixed(m[0]):
            continue
        while at < len(taken) and taken[at][0] < m.end():
            reach = max(reach, taken[at][1])
            at += 1
        if reach <= m.start():
            found.append(("loose", *m.span(), m[0]))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


_SPAN = "struct<kind:string,start:int,end:int,hash:binary>"


def _scan(keep_text: bool):
    """mapInArrow: the input's columns (the text, the last one, if wanted) and ``spans``."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                               ("hash", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = batch.num_columns - (not keep_text)
            spans = [[{"kind": k, "start": s, "end": e, "hash": hashlib.sha256(v.encode()).digest()[:16]}
                      for k, s, e, v in find_spans(t.as_py() or "")] for t in batch.column(batch.num_columns - 1)]
            yield pa.record_batch([*batch.columns[:keep], pa.array(spans, kind)],
                                  names=[*batch.schema.names[:keep], "spans"])
    return run


def _text(col: str):
    return F.coalesce(F.col(f"`{col}`").cast("string"), F.lit(""))


def ownership(scanned: DataFrame) -> DataFrame:
    """hash -> occurrences, repositories and owners, over the whole corpus.
    Three map-side combined steps, so a value that a third of all rows hold is
    one row a task."""
    uses = scanned.select("owner", "repo", F.explode("spans.hash").alias("hash"))
    by_repo = uses.groupBy("hash", "owner", "repo").agg(F.count("*").alias("n"))
    by_owner = by_repo.groupBy("hash", "owner").agg(F.count("*").alias("repos"), F.sum("n").alias("n"))
    return by_owner.groupBy("hash").agg(F.sum("n").alias("uses"), F.sum("repos").alias("repos"),
                                        F.count("*").alias("owners"))


def _live(example_owners: int, example_repos: int):
    return (F.col("owners") < example_owners) & (F.col("repos") < example_repos)


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
            repo_col: str | None = "lang", example_owners: int = EXAMPLE_OWNERS,
            example_repos: int = EXAMPLE_REPOS) -> DataFrame:
    """One row per input row: ``id`` and ``spans``, an array of (start, rank,
    kind, end, hash, uses, repos, owners, live) in the order of the digest.

    A value is live-looking while it has fewer than ``example_owners`` owners
    and stands in fewer than ``example_repos`` repositories. Without a
    ``repo_col`` (None) every document is a repository.

    Null texts count as empty and have no spans. Rows that repeat an id are
    scanned and returned as rows of their own. Extra columns are ignored; an
    empty table gives an empty result.
    """
    found = spill(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"),
        _text(owner_col).alias("owner"), _text(repo_col or id_col).alias("repo"), F.col(f"`{text_col}`").alias("body"))
        .mapInArrow(_scan(False), f"row long, id long, owner string, repo string, spans array<{_SPAN}>"), "spans")
    counts = spill(ownership(found), "ownership")
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("s.kind"))
    judged = (found.select("row", F.explode("spans").alias("s")).withColumn("hash", F.col("s.hash"))
              .join(counts, "hash").withColumn("live", _live(example_owners, example_repos))
              .where((F.col("s.kind") != "loose") | F.col("live"))
              .groupBy("row").agg(F.sort_array(F.collect_list(F.struct(
                  "s.start", rank.alias("rank"), "s.kind", "s.end", "hash", "uses", "repos", "owners", "live")))
                                  .alias("spans")))
    plain = F.array().cast(judged.schema["spans"].dataType)
    return (found.select("row", "id").join(judged, "row", "left")
            .select("id", F.coalesce("spans", plain).alias("spans")))


def redact(docs: DataFrame, text_col: str = "text", owner_col: str = "source", repo_col: str | None = "lang",
           example_owners: int = EXAMPLE_OWNERS, example_repos: int = EXAMPLE_REPOS, mark: str = "[SECRET]",
           id_col: str = "doc_id") -> DataFrame:
    """``docs`` (same columns and rows) with every live-looking span of its
    texts replaced by ``mark``; overlapping spans become one mark. What looks
    live, and ``repo_col``: see :func:`secrets`.

    One pass finds the spans and writes them beside the rows. Rows without
    spans pass through; only rows with spans meet the counts.
    """
    columns = [f"c{i}" for i in range(len(docs.columns))]
    named = docs.select(*[c.alias(own) for c, own in zip(quoted(docs.columns), columns)],
                        F.monotonically_increasing_id().alias("row"), _text(owner_col).alias("owner"),
                        _text(repo_col or id_col).alias("repo"), F.col(f"`{text_col}`").alias("body"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in named.schema.fields[:-1])
    # the text itself is one of the columns c0, c1, ...; the copy ends here
    found = spill(named.mapInArrow(_scan(False), f"{schema}, spans array<{_SPAN}>"), "scanned")
    counts = ownership(found.select("owner", "repo", "spans")).where(_live(example_owners, example_repos))
    cuts = (found.select("row", F.explode("spans").alias("s")).select("row", "s.*")
            .join(counts.select("hash"), "hash")
            .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts")))
    body = columns[docs.columns.index(text_col)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(body), batch.column("cuts")):
                parts, at, text = [], 0, text.as_py()
                for s in spans.as_py() or []:
                    if s["start"] >= at:
                        parts += [text[at:s["start"]], mark]
                    at = max(at, s["end"])
                out.append("".join([*parts, text[at:]]) if parts else text)
            at = batch.schema.get_field_index(body)
            yield (batch.set_column(at, body, pa.array(out, pa.string()))
                   .select(columns))

    hit = (found.where("size(spans) > 0").select(*columns, "row").join(cuts, "row", "left")
           .mapInArrow(cut, ", ".join(schema.split(", ")[:len(columns)])))
    out = found.where("size(spans) = 0").select(*columns).unionByName(hit)
    return out.select(*[F.col(own).alias(c) for own, c in zip(columns, docs.columns)])
