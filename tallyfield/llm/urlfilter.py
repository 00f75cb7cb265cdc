"""URL filters as a sort-merge range join.

A host read from its last label (`www.example.com` -> `com.example.www.`) makes "this host and its subdomains" a
prefix, that is an interval of sorted keys; intervals of such prefixes are nested or apart. Rules sorted by key and
urls sorted by key are swept together with a stack of the rules whose interval is open; for each url the open rules
whose path begins the url's path compete, and the longest (host and path together) wins.

Each task sorts and sweeps the rows it reads, so urls are never shuffled and a host with a third of all pages is as
spread as the files are. Rules come in sorted blocks of bounded size; beyond one block the sweeps follow each other,
each carrying the best rule so far.

Defined cases: null urls and urls without `://` have empty host and path and fit no rule; rules with a null host are
left out, a null path counts as empty; of rules with equal host and path the smallest verdict holds.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rules per block; a block of this size (some 10 MB) goes to every task.
BLOCK = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def key_of(host: str) -> str:
    """Labels from last to first, each with a dot after it: subdomains have their parent's key as prefix."""
    return "".join(f"{x}." for x in reversed(host.split(".")))


def sweep(urls: list[tuple[str, str]], rules: list[tuple[str, str, str, str]]) -> list[tuple[str, str] | None]:
    """The winning (rule, verdict) of each (key, path); rules are (key, path, rule, verdict) in sorted order."""
    out: list = [None] * len(urls)
    stack: list[tuple[str, list]] = []  # open intervals, outermost first, with the rules of each
    nxt, last = 0, None
    for i in sorted(range(len(urls)), key=lambda i: urls[i][0]):
        key, path = urls[i]
        if key != last:
            while nxt < len(rules) and rules[nxt][0] <= key:
                at = rules[nxt][0]
                while stack and not at.startswith(stack[-1][0]):
                    stack.pop()
                if not stack or stack[-1][0] != at:
                    stack.append((at, []))
                stack[-1][1].append(rules[nxt])
                nxt += 1
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            last = key
        best = None
        for _, held in stack:
            for _, p, rule, verdict in held:
                if path.startswith(p) and (best is None or len(rule) >= len(best[0])):
                    best = (rule, verdict)
        out[i] = best
    return out


def apply_rules(pages: DataFrame, rules: DataFrame, default: str = "allow", block: int = BLOCK) -> DataFrame:
    """page_id, host, path, rule, verdict of every page; rules has host, path, verdict.

    The url's text after `://` is host up to `/`, `?` or `#`, then path up to `?` or `#`.
    """
    tail = F.when(F.instr("url", "://") > 0, F.expr("substr(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    df = pages.select("page_id", F.coalesce(tail, F.lit("")).alias("t"))
    df = df.select("page_id", F.regexp_extract("t", r"(?s)^([^/?#]*)", 1).alias("host"), F.regexp_extract("t", r"(?s)^[^/?#]*([^?#]*)", 1).alias("path"))
    df = df.select("page_id", F.translate("host", UPPER, LOWER).alias("host"), "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))

    tidy = rules.where("host is not null").groupBy(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path")).agg(F.min("verdict").alias("verdict"))
    key = F.concat(F.array_join(F.reverse(F.split("host", r"\.")), "."), F.lit("."))
    tidy = tidy.select(key.alias("key"), "path", F.concat("host", "path").alias("rule"), "verdict").orderBy("key", "path")
    sc, held = pages.sparkSession.sparkContext, []
    for row in tidy.toLocalIterator():
        held.append(tuple(row))
        if len(held) == block:
            df, held = _swept(df, sc.broadcast(sorted(held))), []
    return _swept(df, sc.broadcast(sorted(held))) if held else df


def _swept(df: DataFrame, rules) -> DataFrame:
    names = ["page_id", "host", "path", "rule", "verdict"]

    def run(batches):
        for batch in batches:
            cols = {n: batch.column(n).to_pylist() for n in ("host", "path", "rule", "verdict")}
            won = sweep([(key_of(h), p) for h, p in zip(cols["host"], cols["path"])], rules.value)
            best = [new if new and (old is None or len(new[0]) >= len(old)) else (old, verdict) for new, old, verdict in zip(won, cols["rule"], cols["verdict"])]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("host"), batch.column("path"), pa.array([b[0] for b in best], pa.string()), pa.array([b[1] for b in best], pa.string())], names)

    return df.mapInArrow(run, df.schema)
