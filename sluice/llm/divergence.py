"""How far the sources of a language lie from each other and from the language, by their terms."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.session import stage

#: documents of a language that a term must occur in, what is added to each count, the whole of a group's shares
MIN_DOCS, ADDED, WHOLE = 30, 5, 1_000_000_000
#: ranks of the terms part
TOP = 50
#: bytes of a text that are split at a time, distinct terms a task counts before it hands them on
PIECE, HELD = 1 << 20, 400_000
#: postings of a block of terms on average, groups of a block of rows
POSTINGS, ROWS = 200_000, 256
#: lower-cases A-Z and blanks all other ASCII but letters; bytes of longer characters stay
TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)
KEYS = ["lang", "source", "term"]


def term_pieces(text: bytes | None, piece: int = PIECE) -> Iterator[list[bytes]]:
    """The terms of a text in order, a list for every ``piece`` bytes; a longer term stays whole."""
    data = (text or b"").translate(TABLE)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + piece)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def _named(docs: DataFrame) -> DataFrame:
    def of(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    return docs.select(of("lang").alias("lang"), of("source").alias("source"), of("text").cast("binary").alias("text"))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that hold the term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict = defaultdict(lambda: (Counter(), Counter()))

        def rows() -> Iterator[pa.RecordBatch]:
            for (lang, source), (found, held) in counts.items():
                terms = list(found)
                columns = [
                    pa.array([lang] * len(terms), pa.string()),
                    pa.array([source] * len(terms), pa.string()),
                    pa.array(terms, pa.binary()).cast(pa.string()),
                    pa.array(list(found.values()), pa.int64()),
                    pa.array([held[t] for t in terms], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, [*KEYS, "n", "docs"])
            counts.clear()

        size = 0
        for batch in batches:
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text")):
                found, held = counts[lang, source]
                size -= len(found)
                mine: set[bytes] = set()
                for terms in term_pieces(text.as_py()):
                    found.update(terms)
                    mine.update(terms)
                held.update(mine)
                size += len(found)
                if size >= HELD:
                    yield from rows()
                    size = 0
        yield from rows()

    found = _named(docs).mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return found.groupBy(*KEYS).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: str, total: str, kept: str) -> Column:
    """1 + floor(WHOLE * (n + ADDED) / (total + ADDED * kept)) in whole numbers of any size; 0 if no term is kept."""
    above = f"cast({n} + {ADDED} as decimal(27,0)) * cast({WHOLE} as decimal(10,0))"
    return F.expr(f"case when {kept} > 0 then 1 + {above} div cast({total} + {ADDED} * {kept} as decimal(27,0)) else 0L end")


def _one_block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Partial sums of the groups of one block of rows against all peers, over one block of terms.

    Over terms that neither group has, all differ by that of the baselines.
    Each group's own terms correct that by what they differ from the other's
    baseline; terms that both have are corrected once more, by what their
    shares really differ.  For these the group goes through its terms, each leads to
    the peers that have it, and what comes out is added to a dense array
    with a cell a peer.
    """
    cell = left.iloc[0]
    zero = np.asarray(cell["zeros"], dtype=np.int64)
    peers_all = len(zero)
    first = int(cell["r"]) * int(cell["rows"])
    block = np.arange(first, min(first + int(cell["rows"]), peers_all))
    _, term = np.unique(right["term_id"].to_numpy(), return_inverse=True)
    by_term = np.argsort(term, kind="stable")
    term, peer = term[by_term], right["idx"].to_numpy()[by_term].astype(np.int64)
    share = right["p"].to_numpy()[by_term].astype(np.int64)
    starts = np.concatenate(([0], np.cumsum(np.bincount(term)))) if len(term) else np.zeros(1, np.int64)
    # the same postings by group, the shares in order
    by_peer = np.lexsort((share, peer))
    ends = np.searchsorted(peer[by_peer], np.arange(peers_all + 1))

    def beyond(h: int, zeros: np.ndarray) -> np.ndarray:
        """For each baseline, what the shares of ``h`` differ from it more than the baseline of ``h`` does."""
        mine = share[by_peer[ends[h] : ends[h + 1]]]
        before = np.concatenate(([0], np.cumsum(mine)))
        k = np.searchsorted(mine, zeros)
        apart = zeros * k - before[k] + (before[-1] - before[k]) - zeros * (len(mine) - k)
        return apart - len(mine) * np.abs(zero[h] - zeros)

    sums = np.zeros((len(block), peers_all), dtype=np.int64)
    for h in range(peers_all):
        sums[:, h] += beyond(h, zero[block])
    for i, g in enumerate(block.tolist()):
        sums[i] += beyond(g, zero)
        mine = by_peer[ends[g] : ends[g + 1]]
        sizes = starts[term[mine] + 1] - starts[term[mine]]
        if sizes.sum():
            at = np.repeat(starts[term[mine]] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
            own, other, their = np.repeat(share[mine], sizes), share[at], zero[peer[at]]
            more = np.abs(own - other) - np.abs(own - their) - np.abs(zero[g] - other) + np.abs(zero[g] - their)
            # whole numbers far below 2**53, so sums of doubles are exact
            sums[i] += np.bincount(peer[at], weights=more, minlength=peers_all).astype(np.int64)
        if cell["t"] == 0:
            sums[i] += cell["kept"] * np.abs(zero - zero[g])
    g, h = np.repeat(block, peers_all), np.tile(np.arange(peers_all), len(block))
    other = g != h
    out = pd.DataFrame({"g": g[other], "h": h[other], "value": sums.ravel()[other]})
    out.insert(0, "lang", cell["lang"])
    return out


class Shares:
    """The kept terms, the groups and the shares that both parts of the audit are made of.

    Written tables: ``terms`` (lang, term, term_id, q, n), ``groups`` (lang,
    source, idx, zero and the figures of the language), ``postings`` (lang,
    idx, source, term, term_id, p, q).
    """

    def __init__(self, docs: DataFrame):
        counts = stage(term_counts(docs), "term-counts")
        kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        kept = kept.where(F.col("docs") >= MIN_DOCS).select("lang", "term", "n")
        kept = stage(kept.withColumn("term_id", F.monotonically_increasing_id()), "kept-terms")
        found = stage(counts.join(kept.select("lang", "term", "term_id"), ["lang", "term"]).drop("docs"), "kept-counts")
        named = _named(docs).select("lang", "source").distinct()
        numbered = named.withColumn("idx", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
        langs = named.groupBy("lang").agg(F.count("*").alias("peers"))
        of_lang = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n").alias("lang_n"))
        postings = found.groupBy("lang").agg(F.count("*").alias("postings"))
        langs = langs.join(of_lang, "lang", "left").join(postings, "lang", "left").na.fill(0)
        langs = langs.withColumn("blocks", F.greatest(F.ceil(F.col("postings") / POSTINGS), F.lit(1)))
        self.langs = stage(langs, "langs")
        sums = found.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
        groups = numbered.join(sums, ["lang", "source"], "left").join(self.langs, "lang").na.fill(0, ["group_n"])
        self.groups = stage(groups.withColumn("zero", _share("0", "group_n", "kept")), "groups")
        of_term = kept.join(self.langs, "lang").withColumn("q", _share("n", "lang_n", "kept"))
        self.terms = stage(of_term.select("lang", "term", "term_id", "n", "q"), "terms")
        whole = found.join(self.groups, ["lang", "source"]).withColumn("p", _share("n", "group_n", "kept"))
        self.postings = stage(whole.select("lang", "source", "idx", "term", "term_id", "blocks", "peers", "p"), "postings")

    def pairs(self) -> DataFrame:
        """(lang, source, item, value) of every two groups of a language, both ways round."""
        rows_of = F.ceil(F.col("peers") / ROWS)
        zeros = self.groups.groupBy("lang").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("idx", "zero"))), lambda x: x["zero"]).alias("zeros"),
            F.first("kept").alias("kept"), F.first("blocks").alias("blocks"), F.count("*").alias("peers"),
        )
        cells = zeros.where("peers > 1").withColumn("r", F.explode(F.sequence(F.lit(0).cast("long"), rows_of - 1)))
        cells = cells.withColumn("t", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        cells = cells.select("lang", "r", "t", "zeros", "kept", F.lit(ROWS).alias("rows"))
        index = self.postings.where("peers > 1").select(
            "lang", F.explode(F.sequence(F.lit(0).cast("long"), rows_of - 1)).alias("r"),
            F.pmod(F.xxhash64("term_id"), F.col("blocks")).alias("t"), "term_id", "idx", "p",
        )
        by = ["lang", "r", "t"]
        parts = cells.groupBy(*by).cogroup(index.groupBy(*by)).applyInPandas(_one_block, "lang string, g long, h long, value long")
        sums = parts.groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))
        one = self.groups.select("lang", F.col("idx").alias("g"), "source")
        two = self.groups.select("lang", F.col("idx").alias("h"), F.col("source").alias("item"))
        return sums.join(one, ["lang", "g"]).join(two, ["lang", "h"]).select("lang", "source", "item", "value")

    def telling(self) -> DataFrame:
        """(lang, source, item, value) of the terms that a group has more of than its language."""
        both = self.postings.join(self.terms.select("term_id", "q"), "term_id").where("p > q")
        return both.select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))


def audit(docs: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) of both parts.

    Part ``pair`` has a row for every other source of the language, with all
    ranks, part ``term`` the ``top`` terms that the source has more of than
    the language.  Ranks go by falling value, ties by the item's bytes.

    A null text, lang or source is an empty one.  Every row is a document of
    its own, rows of one id too.  A group without terms has the baseline
    share of every term; in a language that keeps no term all pairs have
    value 0.  A language with one source has no pairs, an empty table no
    rows.  Other columns are not read.  A text is split a megabyte at a
    time, a term of any length is one term.

    Terms are counted in the tasks and shuffled by language, source and term
    together.  The pairs are formed block by block: a cell has the groups of
    one block of rows and the postings of one block of terms, and returns one
    partial sum for each two groups, however many terms they share.
    """
    shares = Shares(docs)
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = shares.pairs().withColumn("rank", rank)
    terms = shares.telling().withColumn("rank", rank).where(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs, terms = pairs.withColumn("part", F.lit("pair")), terms.withColumn("part", F.lit("term"))
    return pairs.select(columns).unionByName(terms.select(columns))
