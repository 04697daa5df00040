"""URL rules in a sorted digest array.

The rules' keys (host and path as one string) are hashed with 64-bit xxhash and written, sorted,
to one file beside the strings themselves. Every task maps that file into memory, looks all
candidate keys of a batch of urls up by one vectorised binary search, and confirms a hit on the
full string, so that a collision of hashes changes nothing.
"""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, functions as F

from .common import shared_dir

#: The rules of the registered query (host, path, verdict).
DEFAULT_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_open: dict[str, "DigestArray"] = {}


class DigestArray:
    """Memory-mapped, sorted 64-bit digests; each entry's string and verdict lie behind them."""

    def __init__(self, path: str):
        head = np.fromfile(path, "<u8", 3)
        n, lengths = int(head[0]), int(head[1])
        self.digests = np.memmap(path, "<u8", "r", 24, (n,)) if n else np.zeros(0, "<u8")
        self.bounds = np.memmap(path, "<u8", "r", 24 + 8 * n, (n + 1,))
        self.lengths = np.fromfile(path, "<u8", lengths, offset=24 + 8 * (2 * n + 1)).tolist()
        self.start = 24 + 8 * (2 * n + 1 + lengths)
        self.text = np.memmap(path, np.uint8, "r", self.start, (int(self.bounds[-1]),)) if n else b""

    @staticmethod
    def write(rules: list[tuple[str, str, str]], path: str) -> None:
        """A later rule for the same host and path replaces an earlier one."""
        last = {host.encode().lower().decode() + p: v for host, p, v in rules}
        entries = sorted((xxhash.xxh64_intdigest(k.encode()), k, v) for k, v in last.items())
        lengths = sorted({len(p) for _, p, _ in rules})
        blobs = [v.encode() + b"\0" + k.encode() for _, k, v in entries]
        with open(path, "wb") as out:
            out.write(np.array([len(entries), len(lengths), 0], "<u8").tobytes())
            out.write(np.array([d for d, _, _ in entries], "<u8").tobytes())
            out.write(np.cumsum([0, *map(len, blobs)]).astype("<u8").tobytes())
            out.write(np.array(lengths, "<u8").tobytes())
            out.write(b"".join(blobs))

    def find(self, keys: list[bytes]) -> list[str | None]:
        """The verdict of each key, None for keys that are no rule."""
        found: list[str | None] = [None] * len(keys)
        if not len(self.digests) or not keys:
            return found
        asked = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
        at = np.searchsorted(self.digests, asked)
        hits = np.flatnonzero((at < len(self.digests)) & (self.digests[np.minimum(at, len(self.digests) - 1)] == asked))
        for i in hits.tolist():
            k = int(at[i])
            while k < len(self.digests) and self.digests[k] == asked[i]:  # all strings of this digest
                verdict, _, key = self.text[int(self.bounds[k]) : int(self.bounds[k + 1])].tobytes().partition(b"\0")
                if key == keys[i]:
                    found[i] = verdict.decode()
                k += 1
        return found


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null and without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*(/[^?#]*)", 1), F.lit(""))


def candidate_keys(tail: str, path: str, longest: int, lengths: list[int]) -> list[tuple[str, str]]:
    """(host suffix, path prefix) of every rule that could fit, the longest first.

    tail is the host's end: all of it up to `longest` characters, else one character more. Rules
    have no longer hosts, so no longer suffix is built, whatever the host's length.
    """
    suffixes = [tail] if len(tail) <= longest else []
    dot = tail.find(".")
    while dot >= 0:
        suffixes.append(tail[dot + 1 :])
        dot = tail.find(".", dot + 1)
    pairs = [(h, path[:n]) for h in suffixes if h for n in lengths if n <= len(path)]
    return sorted(pairs, key=lambda p: (-len(p[0]) - len(p[1]), -len(p[0])))


def url_filter(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    otherwise: str = "allow",
    id_col: str = "page_id",
    url_col: str = "url",
    max_bytes: int = 1 << 31,
) -> DataFrame:
    """(id, host, path, rule, verdict) of every row of pages.

    A rule (host, path, verdict) fits its host and all subdomains if the url's path begins with
    the rule's path. The longest host and path together win, of equally long ones the longer
    host. rule is the fitting rule's host and path as one string, null if none fits; verdict is
    then `otherwise`. A null url, or one without `://`, has an empty host and path and fits no
    rule. Repeated rows are judged each; extra columns are ignored; an empty table stays empty.

    Urls are taken apart by Column functions; only the ends of hosts and beginnings of paths
    that rules can reach go to Python, so a url of any length costs no more than its parts. The
    rules are a list that the caller holds, so the array's size is known: above max_bytes this
    raises, and larger lists go through url_filter_joined. The file is staged in the shared
    folder where that is a mounted one, and each host of the cluster gets it once.
    """
    size = sum(len(h) + len(p) + len(v) + 32 for h, p, v in rules)
    if size > max_bytes:
        raise ValueError(f"the rules take about {size} bytes, more than {max_bytes}: use url_filter_joined")
    spark = pages.sparkSession
    name = f"digests-{uuid.uuid4().hex}"
    staged = os.path.join(_mounted(shared_dir(spark)), name)
    DigestArray.write(rules, staged)
    spark.sparkContext.addFile(staged)
    longest, deepest = max((len(h) for h, _, _ in rules), default=0), max((len(p) for _, p, _ in rules), default=0)

    def look_up(tails: pa.Array, paths: pa.Array) -> pa.Array:
        if name not in _open:
            _open.clear()
            _open[name] = DigestArray(SparkFiles.get(name))
        index, owner, keys = _open[name], [], []
        for i, (tail, path) in enumerate(zip(tails.to_pylist(), paths.to_pylist())):
            for h, p in candidate_keys(tail, path, longest, index.lengths):
                owner.append(i)
                keys.append(h + p)
        fits, verdicts = [None] * len(tails), [otherwise] * len(tails)
        for i, key, verdict in zip(owner, keys, index.find([k.encode() for k in keys])):
            if verdict is not None and fits[i] is None:
                fits[i], verdicts[i] = key, verdict
        return pa.StructArray.from_arrays([pa.array(fits, pa.string()), pa.array(verdicts, pa.string())], ["rule", "verdict"])

    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    found = F.arrow_udf(look_up, "struct<rule: string, verdict: string>")(F.right("host", F.lit(longest + 1)), F.left("path", F.lit(deepest)))
    return rows.withColumn("found", found).select("id", "host", "path", "found.rule", "found.verdict")


def _mounted(folder: str) -> str:
    """A folder to stage a file in: the shared one where the driver can write there, else a temporary one."""
    place = folder.removeprefix("file:").replace("///", "/", 1) if folder.startswith("file:") else folder
    if "://" in place:
        return tempfile.mkdtemp()
    place = os.path.join(place, "tilewright")
    os.makedirs(place, exist_ok=True)
    return place


def url_filter_joined(
    pages: DataFrame, rules: DataFrame, lengths: list[int], otherwise: str = "allow", id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """url_filter for rules in a table (host, path, verdict) of any size, by a shuffled join on the candidate keys.

    lengths are the path lengths that occur in rules. Only suffixes as long as the longest rule
    host are built. Equal urls are judged once, so that a hot page is one row of the join.
    """
    longest = rules.agg(F.max(F.length("host")).alias("n")).first()["n"] or 0
    host, path = host_and_path(F.col(url_col))
    urls = pages.select(url_col).distinct().select(url_col, host.alias("host"), path.alias("path"))
    labels = F.split(F.right("host", F.lit(longest + 1)), "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    suffixes = F.filter(suffixes, lambda h: F.length(h) <= longest)
    prefixes = F.filter(F.array(*(F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths)), lambda p: p.isNotNull())
    keys = urls.select(url_col, F.explode(suffixes).alias("h"), "path").select(url_col, "h", F.explode(prefixes).alias("p"))
    best = (
        keys.where("h != ''")
        .join(rules.select(F.translate("host", UPPER, LOWER).alias("h"), F.col("path").alias("p"), "verdict"), ["h", "p"])
        .groupBy(url_col)
        .agg(F.max(F.struct((F.length("h") + F.length("p")).alias("n"), F.length("h").alias("m"), F.concat("h", "p").alias("rule"), "verdict")).alias("best"))
    )
    judged = urls.join(best, url_col, "left").select(F.col(url_col).alias("u"), "host", "path", "best.rule", "best.verdict")
    own = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("asked"))
    return own.join(judged, F.col("asked").eqNullSafe(F.col("u")), "left").select(
        "id",
        F.coalesce("host", F.lit("")).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
        "rule",
        F.coalesce("verdict", F.lit(otherwise)).alias("verdict"),
    )
