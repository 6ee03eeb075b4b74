"""Secrets in texts: fixed patterns, and strings that a Markov model takes for random.

Everything is DataFrame functions inside the row; only the counts of
character pairs are shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import free_mark, named, once, text_of
from sluice.session import stage

#: fixed values: the base patterns; letters of the key words in either case
ASSIGN = (
    r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
#: runs of fewer characters of a hex or access pattern fail; as runs are maximal they need not be listed
ACCESS_LONG, HEX_LONG = r"AKIA[A-Z0-9]{14,}", r"[0-9a-f]{16,}"
MIN_VALUE = 12
KINDS = ("assign", "access", "hex")
#: strings that the model judges, and its least log-likelihood ratio in all and per character pair
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
MIN_SCORE, MIN_RATE = 12.0, 0.4
#: ordinary identifiers to learn from: words of a length like that of a secret
ORDINARY = r"[A-Za-z0-9_-]{8,}"
#: weight of the frequency of single characters in that of pairs; most that one pair can say
BACKOFF, MOST = 8.0, 3.0
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
#: entries of an array that are summed in one go
RUN = 256
#: code points of a block of a text
BLOCK = 4096


def _running(array: Column) -> Column:
    """Sums up to each entry, in runs so that long arrays are not copied for each entry."""
    runs = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(array) - 1) / RUN).cast("int")),
        lambda r: F.slice(array, r * RUN + 1, F.lit(RUN)),
    )
    append = lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))
    zero = F.array(F.lit(0).cast("long"))
    inside = F.transform(runs, lambda r: F.slice(F.aggregate(r, zero, append), F.lit(2), F.lit(RUN)))
    before = F.aggregate(F.transform(inside, lambda r: F.element_at(r, -1)), zero, append)
    whole = F.flatten(F.zip_with(inside, F.slice(before, F.lit(1), F.size(inside)), lambda r, b: F.transform(r, lambda x: x + b)))
    return F.when(F.size(array) > 0, whole).otherwise(F.array().cast("array<bigint>"))


def _found(df: DataFrame, text: Column, name: str, pattern: str, keep) -> DataFrame:
    """Adds ``name``: an array of (start, end, value) of the matches that ``keep`` accepts.

    The text between the matches gives their places: starts are sums of the
    lengths before them.
    """
    matches, gaps = f"{name}_m", f"{name}_g"
    df = once(df, matches, F.regexp_extract_all(text, F.lit(pattern), 0))
    some = F.size(matches) > 0
    none = F.array().cast("array<bigint>")
    df = once(df, gaps, F.when(some, F.split(text, pattern, -1)))
    lengths = F.flatten(
        F.zip_with(
            F.slice(F.col(gaps), F.lit(1), F.size(matches)),
            F.col(matches),
            lambda g, m: F.array(F.length(g).cast("long"), F.length(m).cast("long")),
        )
    )
    # lengths of gap, match, gap, match ...
    df = once(df, f"{name}_l", F.when(some, lengths).otherwise(none))
    df = once(df, f"{name}_e", F.when(some, _running(F.col(f"{name}_l"))).otherwise(none))
    ends = F.col(f"{name}_e")
    spans = F.transform(
        F.col(matches),
        lambda m, i: F.struct(F.get(ends, 2 * i).alias("start"), F.get(ends, 2 * i + 1).alias("end"), m.alias("value")),
    )
    kept = F.when(some, F.filter(spans, keep)).otherwise(F.array().cast("array<struct<start:bigint,end:bigint,value:string>>"))
    return once(df, name, kept).drop(matches, gaps, f"{name}_l", f"{name}_e")


def _long_value(span: Column) -> Column:
    return F.length(F.regexp_extract(span["value"], f"^{ASSIGN}$", 2)) >= MIN_VALUE


def _any(span: Column) -> Column:
    return F.lit(True)


def base_spans(docs: DataFrame, mark: str = "_s_") -> DataFrame:
    """Adds arrays of spans, in code points, of the three base kinds."""
    text = text_of()
    docs = _found(docs, text, f"{mark}assign", ASSIGN, _long_value)
    docs = _found(docs, text, f"{mark}access", ACCESS_LONG, _any)
    return _found(docs, text, f"{mark}hex", HEX_LONG, _any)


def samples(docs: DataFrame) -> DataFrame:
    """(word, secret): labelled strings of all texts.

    Values that the base patterns find are secrets; words of letters of a like
    length, in which no base pattern finds anything, are ordinary.
    """
    slim = base_spans(docs.select("text"))
    values = F.concat(
        F.transform("_s_assign", lambda s: F.regexp_extract(s["value"], f"^{ASSIGN}$", 2)),
        F.transform("_s_access", lambda s: s["value"]),
        F.transform("_s_hex", lambda s: s["value"]),
    )
    secret = slim.select(F.explode(values).alias("word"), F.lit(True).alias("secret"))
    rest = F.regexp_replace(text_of(), ASSIGN, " ")
    ordinary = docs.select(F.explode(F.regexp_extract_all(rest, F.lit(ORDINARY), 0)).alias("word"), F.lit(False).alias("secret"))
    return secret.union(ordinary.where(~F.col("word").rlike(f"{ACCESS_LONG}|{HEX_LONG}")))


def train(labelled: DataFrame) -> list[float]:
    """Log-likelihood ratios of character pairs, a row of the alphabet for each first character.

    Two first-order Markov models, of random strings and of ordinary
    identifiers.  A pair that was seen seldom leans on the frequency of its
    second character, and no pair says more than MOST, so that a few digits in
    a name do not outweigh its letters.  The counts that reach the driver are
    at most one for each pair of alphabet characters and label.
    """
    pairs = (
        labelled.where(F.length("word") > 1)
        .groupBy("secret", "word").agg(F.count("*").alias("k"))
        .select("secret", "k", F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring(F.col("word"), i, F.lit(2)))).alias("pair"))
        .where(F.col("pair").rlike("^[A-Za-z0-9+/_=.-]{2}$"))
        .groupBy("secret", "pair").agg(F.sum("k").alias("n"))
    )
    count: dict[bool, dict[str, int]] = {True: {}, False: {}}
    for row in pairs.collect():
        count[row["secret"]][row["pair"]] = row["n"]
    chance: dict[bool, list[float]] = {}
    for label, found in count.items():
        single = [1 + sum(found.get(a + b, 0) for a in ALPHABET) for b in ALPHABET]
        share = [n / sum(single) for n in single]
        chance[label] = []
        for a in ALPHABET:
            row = [found.get(a + b, 0) + BACKOFF * p for b, p in zip(ALPHABET, share)]
            total = sum(row)
            chance[label] += [math.log(n / total) for n in row]
    return [min(MOST, max(-MOST, r - o)) for r, o in zip(chance[True], chance[False])]


def score(word: Column, model: list[float]) -> Column:
    """Sum of the pairs' log-likelihood ratios: above zero is more like random strings."""
    # one literal: the text of the numbers folds into an array when the plan is made
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in model)), ",").cast("array<double>")
    places = F.transform(
        F.sequence(F.lit(1), F.length(word)),
        lambda i: F.position(F.substring(word, i, F.lit(1)), F.lit(ALPHABET)),
    )
    pairs = F.zip_with(
        F.slice(places, F.lit(1), F.length(word) - 1),
        F.slice(places, F.lit(2), F.length(word) - 1),
        lambda a, b: F.get(table, (a - 1) * len(ALPHABET) + b - 1),
    )
    return F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + F.coalesce(x, F.lit(0.0)))


def is_random(word: Column, model: list[float]) -> Column:
    """Whether the ratio says so, for letters alone as for letters with digits."""
    return score(word, model) >= F.greatest(F.lit(MIN_SCORE), MIN_RATE * (F.length(word) - 1))


def scan(docs: DataFrame, model: list[float] | None = None, mark: str = "_s_") -> DataFrame:
    """The rows with arrays of spans: the base kinds, and ``markov`` for what only the model finds.

    A candidate inside a base span, or one that touches the span of an
    assignment, whose value ends where the candidate does, is no span of its
    own; one that reaches beyond a hex or access span is, so that no part of a
    longer key is left.  Without a model one is trained on these rows.  Null
    and empty texts have no spans; repeated rows are scanned each; an empty
    table gives an empty one.  ``mark`` must not begin a column's name.
    """
    if model is None:
        model = train(samples(docs))
    found = base_spans(docs, mark)
    found = _found(found, text_of(), f"{mark}run", CANDIDATE, _any)
    within = lambda s, b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])
    touch = lambda s, b: (b["start"] < s["end"]) & (s["start"] < b["end"])
    free = lambda s: ~(
        F.exists(F.col(f"{mark}assign"), lambda b: touch(s, b))
        | F.exists(F.col(f"{mark}access"), lambda b: within(s, b))
        | F.exists(F.col(f"{mark}hex"), lambda b: within(s, b))
    )
    random = F.filter(F.col(f"{mark}run"), lambda s: free(s) & is_random(s["value"], model))
    return found.withColumn(f"{mark}markov", F.when(F.size(f"{mark}run") > 0, random).otherwise(F.col(f"{mark}run"))).drop(f"{mark}run")


def listed(kinds: tuple[str, ...], mark: str = "_s_") -> Column:
    """kind:start:end of the spans by start, then kind as listed, joined by commas."""
    def tag(place: int) -> Column:
        return F.transform(
            F.col(f"{mark}{kinds[place]}"),
            lambda s: F.struct(s["start"].alias("start"), F.lit(place).alias("kind"), s["end"].alias("end")),
        )

    tagged = F.concat(*(tag(i) for i in range(len(kinds))))
    names = F.array(*(F.lit(k) for k in kinds))
    text = F.transform(F.sort_array(tagged), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
    return F.array_join(text, ",")


def _starts_and_ends(spans: Column) -> Column:
    """Starts (step 1) and ends (step -1) of spans in order, ends first in a tie.

    With the number of spans open after each, a start that leaves one open
    begins a merged span and an end that leaves none open ends it: those
    that overlap are one, those that only touch stay apart.
    """
    starts = F.transform(spans, lambda s: F.struct(s["start"].alias("at"), F.lit(1).cast("long").alias("step")))
    ends = F.transform(spans, lambda s: F.struct(s["end"].alias("at"), F.lit(-1).cast("long").alias("step")))
    return F.sort_array(F.concat(starts, ends))


def redacted(docs: DataFrame, model: list[float] | None = None, filler: str = "[SECRET]") -> DataFrame:
    """The rows with every span of their text replaced by ``filler``; n_chars, if there, follows.

    Overlapping spans are replaced as one.  Rows without spans are unchanged,
    null and empty texts among them; repeated rows are treated each; an empty
    table stays empty; columns may have any names.  The work grows with the
    text's length and the number of spans, not with their product.
    """
    columns = docs.columns
    mark = free_mark(docs, "_s_")
    found = scan(docs, model, mark)
    spans = F.concat(*(
        F.transform(F.col(f"{mark}{k}"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
        for k in (*KINDS, "markov")
    ))
    found = once(found, f"{mark}all", spans)
    some = F.size(f"{mark}all") > 0
    found = once(found, f"{mark}marks", _starts_and_ends(F.col(f"{mark}all")))
    found = once(found, f"{mark}open", _running(F.transform(F.col(f"{mark}marks"), lambda m: m["step"])))
    with_open = F.arrays_zip(
        F.transform(F.col(f"{mark}marks"), lambda m: m["at"]).alias("at"),
        F.transform(F.col(f"{mark}marks"), lambda m: m["step"]).alias("step"),
        F.col(f"{mark}open").alias("open"),
    )
    found = once(found, f"{mark}zip", with_open)
    begins = F.transform(F.filter(F.col(f"{mark}zip"), lambda z: (z["step"] == 1) & (z["open"] == 1)), lambda z: z["at"])
    stops = F.transform(F.filter(F.col(f"{mark}zip"), lambda z: (z["step"] == -1) & (z["open"] == 0)), lambda z: z["at"])
    zero = F.array(F.lit(0).cast("long"))
    # what stays: from the end of a merged span, or the text's start, to the next one or the text's end
    length = F.array(F.length(text_of()).cast("long"))
    stays = F.zip_with(F.concat(zero, stops), F.concat(begins, length), lambda a, b: F.struct(a.alias("start"), b.alias("end")))
    found = once(found, f"{mark}stays", F.when(some, stays))
    # blocks of the text, so that a piece is not looked for from the text's start
    found = once(found, f"{mark}blocks", F.when(some, F.regexp_extract_all(text_of(), F.lit(f"(?s).{{1,{BLOCK}}}"), 0)))
    blocks = F.col(f"{mark}blocks")

    def cut(s: Column) -> Column:
        first, last = F.floor(s["start"] / BLOCK).cast("int"), F.floor(s["end"] / BLOCK).cast("int")
        at, end = (s["start"] % BLOCK).cast("int"), (s["end"] % BLOCK).cast("int")
        nth = lambda i: F.coalesce(F.get(blocks, i), F.lit(""))
        inside = F.substring(nth(first), at + 1, end - at)
        across = F.concat(
            F.substring(nth(first), at + 1, F.lit(BLOCK)),
            F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
            F.substring(nth(last), F.lit(1), end),
        )
        return F.when(first == last, inside).otherwise(across)

    done = F.array_join(F.transform(F.col(f"{mark}stays"), cut), filler)
    found = found.withColumn("text", F.when(some, done).otherwise(F.col("text")))
    if "n_chars" in columns:
        found = found.withColumn("n_chars", F.when(some, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return found.select(*map(named, columns))
