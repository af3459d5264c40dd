"""URL rules in a sorted digest array.

A rule is an action (allow or block), a host and a path. It fits its host and all
subdomains, when the path of the url starts with the rule's; of those that fit, the
longest (host and path together; then the longer host; then block before allow) decides.

All rules lie in one file: sorted 64-bit xxhash keys, and the full rule strings in the
order of the keys. The driver writes it to the shared folder and Spark hands it to every
executor, also to one that is started later; workers map it into memory, so its size
costs disk and page cache but no heap. Each url asks for each suffix of its host by
vectorised binary search; a key that is there is confirmed by the stored strings, so two
strings of equal hash are never mistaken for each other.

A null url, or one without ``://``, has an empty host and an empty path and fits no rule.
No rule at all gives every url the default verdict. Rows are independent.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tidewater.session import shared_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), "^(?s).*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "^(?s).*?://[^/?#]*([^?#]*)", 1)


def digest_file(rules: Iterable[tuple[str, str, str]]) -> bytes:
    """The file for rules of (action, host, path): counts, sorted keys, ends of the entries, entries.

    An entry holds a host and all its rules, so that one probe answers for a host.
    """
    hosts: dict[str, set[str]] = {}
    for action, host, path in rules:
        if action not in ("allow", "block"):
            raise ValueError(f"a rule allows or blocks, it does not {action!r}")
        hosts.setdefault(host.translate(str.maketrans(UPPER, LOWER)), set()).add(f"{action[0]}{path}")
    rows = sorted((xxhash.xxh64_intdigest(h), "\n".join([h, *sorted(paths)]).encode()) for h, paths in hosts.items())
    keys = np.array([k for k, _ in rows], np.uint64)
    ends = np.cumsum([len(e) for _, e in rows]).astype(np.int64)
    return np.array([len(rows)], np.int64).tobytes() + keys.tobytes() + ends.tobytes() + b"".join(e for _, e in rows)


class DigestArray:
    """The rules of a digest file, mapped into memory."""

    def __init__(self, path: str):
        data = np.memmap(path, np.uint8, "r")
        n = int(data[:8].view(np.int64)[0])
        self.keys = data[8 : 8 + 8 * n].view(np.uint64)
        self.ends = data[8 + 8 * n : 8 + 16 * n].view(np.int64)
        self.entries = data[8 + 16 * n :]

    def entry(self, i: int) -> list[str]:
        start = int(self.ends[i - 1]) if i else 0
        return self.entries[start : int(self.ends[i])].tobytes().decode().split("\n")

    def decide(self, hosts: list[str], paths: list[str]) -> list[tuple[str, str] | None]:
        """Rule and action for each url, or None where no rule fits."""
        out: list[tuple[str, str] | None] = [None] * len(hosts)
        if not len(self.keys):
            return out
        suffixes, rows = [], []
        for row, host in enumerate(hosts):
            while host:
                suffixes.append(host)
                rows.append(row)
                host = host.partition(".")[2]
        wanted = np.fromiter(map(xxhash.xxh64_intdigest, suffixes), np.uint64, len(suffixes))
        first = np.searchsorted(self.keys, wanted)
        hits = np.flatnonzero(self.keys[np.minimum(first, len(self.keys) - 1)] == wanted)
        best: dict[int, tuple] = {}
        for k in hits.tolist():
            i = int(first[k])
            while i < len(self.keys) and self.keys[i] == wanted[k]:  # equal keys of different hosts
                host, *rules = self.entry(i)
                i += 1
                if host != suffixes[k]:
                    continue
                for rule in rules:
                    path = rule[1:]
                    if paths[rows[k]].startswith(path):
                        fits = (len(host) + len(path), len(host), rule[0] == "b", host + path)
                        best[rows[k]] = max(best.get(rows[k], fits), fits)
        for row, (_, _, block, rule) in best.items():
            out[row] = (rule, "block" if block else "allow")
        return out


@functools.cache
def digest_array(path: str) -> DigestArray:
    return DigestArray(path)


def ship(spark: SparkSession, data: bytes, label: str) -> str:
    """Write bytes to the shared folder and hand them to all executors; their file name there."""
    name = f"{label}-{hashlib.sha256(data).hexdigest()[:32]}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = files.create(path, True)
    stream.write(data)
    stream.close()
    spark.sparkContext.addFile(files.makeQualified(path).toString())
    return name


def judge(host: Column, path: Column, name: str, default: str = "allow") -> Column:
    """A struct of the deciding rule (null if none fits) and the verdict, by the shipped file ``name``."""

    def decided(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        rules = digest_array(SparkFiles.get(name))
        for hosts, paths in batches:
            found = rules.decide(hosts.fill_null("").to_pylist(), paths.fill_null("").to_pylist())
            rule = pa.array([x and x[0] for x in found], pa.string())
            verdict = pa.array([x[1] if x else default for x in found], pa.string())
            yield pa.StructArray.from_arrays([rule, verdict], ["rule", "verdict"])

    decided.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(decided, "struct<rule:string,verdict:string>")(host, path)
