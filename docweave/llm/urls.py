"""Operator 9: allow and block rules for URLs, probed in a sorted array of digests."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: More rules than this go through a join; so many fit the driver and every worker.
MOST_RULES = 2_000_000
#: Different lengths of rule paths that each URL is probed with.
MOST_LENGTHS = 1000


def host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty if there is none or the URL is null."""
    found = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    lower = F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ?, # or the end; empty if there is no :// or the URL is null."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


class DigestArray:
    """Rules in three files, mapped into memory: sorted 64-bit digests, where each rule's string lies, the strings."""

    @staticmethod
    def write(rules: dict[str, str], stem: str) -> list[str]:
        keys = sorted((xxhash.xxh3_64_intdigest(k), k.encode(), v) for k, v in rules.items())
        texts = [v[:1].encode() + k for _, k, v in keys]
        np.cumsum([0, *map(len, texts)]).astype("<i8").tofile(f"{stem}.at")
        with open(f"{stem}.text", "wb") as f:
            f.write(b"".join(texts))
        np.array([k for k, _, _ in keys], dtype="<u8").tofile(f"{stem}.keys")  # last: where it is, all are
        return [f"{stem}.keys", f"{stem}.at", f"{stem}.text"]

    def __init__(self, stem: str) -> None:
        load = lambda end, kind: np.memmap(f"{stem}.{end}", dtype=kind, mode="r") if os.path.getsize(f"{stem}.{end}") else np.zeros(0, dtype=kind)
        self.keys, self.at, self.text = load("keys", "<u8"), load("at", "<i8"), load("text", "u1")

    def probe(self, candidates: list[str]) -> list[str | None]:
        """Verdict letter (a or b) of each candidate that is a rule, else None: one binary search for all digests, then the strings are compared."""
        digests = np.array([xxhash.xxh3_64_intdigest(c) for c in candidates], dtype=np.uint64)
        out: list[str | None] = [None] * len(candidates)
        low = np.searchsorted(self.keys, digests)
        hit = np.flatnonzero((low < len(self.keys)) & (self.keys[np.minimum(low, max(0, len(self.keys) - 1))] == digests)) if len(self.keys) else []
        for i in hit:
            want, k = candidates[i].encode(), int(low[i])
            while k < len(self.keys) and self.keys[k] == digests[i]:
                stored = bytes(self.text[self.at[k] : self.at[k + 1]])
                if stored[1:] == want:
                    out[i] = chr(stored[0])
                    break
                k += 1
        return out


def _suffixes(name: str, labels: int) -> list[str]:
    """The host and every domain above it, of those that have at most so many labels."""
    parts = name.rsplit(".", labels)
    parts = parts[1:] if len(parts) > labels else parts
    return [".".join(parts[k:]) for k in range(len(parts))]


def judge(urls: DataFrame, rules: DataFrame, default: str = "allow", most_rules: int = MOST_RULES) -> DataFrame:
    """All columns of urls (url among them) and host, path, rule, verdict.

    rules has (host, path, verdict): verdict is allow or block. A rule fits its host and all its subdomains if the
    URL's path starts with the rule's path; of several the longest host + path wins, and of equally long ones the
    one with the longer host. Without a rule, rule is null and verdict is `default`. A null URL or one without ://
    has an empty host and path and no rule. A rule that stands twice with both verdicts blocks; rules with a null
    are ignored, and so are those whose path is neither empty nor starts with /. Columns of urls named as an added one
    are replaced. Rules up to most_rules, with paths of at most MOST_LENGTHS different lengths, are a digest array in the
    shared folder that each worker maps into memory; others are joined on the candidates instead, with the same result.
    Of a host only the domains with as many labels as some rule has are looked up, however long it is.
    """
    spark = urls.sparkSession
    base = urls.drop("host", "path", "rule", "verdict").withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    clean = rules.where("host is not null and path is not null and verdict in ('allow', 'block') and host <> ''")
    clean = clean.where("path = '' or startswith(path, '/')")  # a URL's path can't start otherwise, and host and path stay apart when joined
    clean = clean.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    labels = clean.agg(F.coalesce(F.max(F.size(F.split("host", r"\."))), F.lit(1))).first()[0]
    lengths = sorted(r[0] for r in clean.select(F.length("path").alias("n")).distinct().limit(MOST_LENGTHS + 1).collect())
    if len(lengths) > MOST_LENGTHS or clean.limit(most_rules + 1).count() > most_rules:
        return _joined(base, clean, default, labels)
    listed = {f"{r.host}{r.path}": r.verdict for r in clean.collect()}
    # The files are named by what they hold, so that the same rules are written once an application.
    name = xxhash.xxh3_128_hexdigest(repr(sorted(listed.items())).encode())
    folder = f"{common.shared_dir(spark).removeprefix('file:')}/{spark.sparkContext.applicationId}"
    os.makedirs(folder, exist_ok=True)
    stem = f"{folder}/rules-{name}"
    if not os.path.exists(f"{stem}.keys"):
        DigestArray.write(listed, stem)
    names, kept = base.columns, base.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = DigestArray(stem)
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            owner, candidates = [], []
            for i, (h, p) in enumerate(zip(hosts, paths, strict=True)):
                starts = [p[:n] for n in lengths if n <= len(p)]
                for s in _suffixes(h, labels) if h else []:
                    candidates += [s + x for x in starts]
                    owner += [(i, len(s), len(s) + len(x)) for x in starts]
            best: list[tuple[int, int, str, str] | None] = [None] * batch.num_rows
            for (i, n, whole), rule, verdict in zip(owner, candidates, array.probe(candidates), strict=True):
                if verdict and (best[i] is None or (whole, n) > best[i][:2]):
                    best[i] = (whole, n, rule, {"a": "allow", "b": "block"}[verdict])
            columns = [*batch.columns, pa.array([b and b[2] for b in best], pa.string()), pa.array([b[3] if b else default for b in best], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "rule", "verdict"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.fields)
    return base.mapInArrow(run, f"{schema}, rule string, verdict string")


def _joined(base: DataFrame, clean: DataFrame, default: str, labels: int) -> DataFrame:
    """The same by a join on the hosts above each distinct host and path, for rules of any number."""
    names = base.where("host <> ''").select("host", "path").distinct()
    parts = F.split("host", r"\.")
    first = F.greatest(F.lit(1), F.size(parts) - labels + 1)
    above = F.transform(F.sequence(first, F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    probes = names.select("host", "path", F.explode(above).alias("above"))
    known = clean.select(F.col("host").alias("above"), F.col("path").alias("start"), "verdict")
    fits = probes.join(known, "above").where("startswith(path, start)")
    length = F.struct(F.length("above") + F.length("start"), F.length("above"))
    best = fits.groupBy("host", "path").agg(F.max_by(F.struct(F.concat("above", "start").alias("rule"), "verdict"), length).alias("b"))
    out = base.join(best, ["host", "path"], "left")
    return out.select(*base.columns, F.col("b.rule").alias("rule"), F.coalesce(F.col("b.verdict"), F.lit(default)).alias("verdict"))
