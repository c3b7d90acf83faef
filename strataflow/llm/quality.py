"""Quality rules: a decision list of threshold conjunctions, learned by sequential covering from labelled statistics, as one ordered conditional expression. JVM only."""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import discard, written

#: What separates words, what counts as a symbol, and the words of a window.
_SPACE, _SYMBOLS, WINDOW = r"[\x20\x09-\x0D]+", r"[^#*$%&|<>]+", 8
#: A text fails at once with fewer words, or with more than so many percent of its words in repeated windows.
LEAST_WORDS, MOST_REPEATED = 20, 30
#: Labelled rows that rules are learned from (about; drawn by a hash of the id if there are more), rules, conditions of a rule, rows that a rule must cover and share of them that must be labelled bad, both
#: in the third of the rows that rules are pruned on.
SAMPLE_ROWS, RULES, CONDITIONS, LEAST_COVER, LEAST_PRECISION = 1_000_000, 12, 4, 5, 0.95

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_digits", "n_marks", "n_chars")


def _share(part: str, whole: str, of: int = 1000) -> str:
    return f"if({whole} > 0, least({of} * {part} div {whole}, 1000), 0)"


#: What rules look at, as SQL over STATISTICS: whole numbers from 0 to about 1,000 each, so that a rule reads well and a histogram of any number of rows is small.
FEATURES = {
    "words_log": "least(floor(16 * log2(n_words + 1)), 1000)", "word_length": _share("word_chars", "n_words", 10), "symbols": _share("n_symbols", "n_chars"), "marks": _share("n_marks", "n_chars"),
    "digits": _share("n_digits", "n_chars"), "capitals": _share("n_upper", "n_chars"), "dup_lines": _share("n_dup_lines", "n_lines"), "repeated": _share("n_repeat_words", "n_words"),
    "distinct": _share("n_distinct", "n_words"), "lines": _share("n_lines", "n_words"),
}


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs without the text, with STATISTICS (all long): words and their code points, symbols, lines with a word that repeat an earlier line, words in windows of WINDOW words that occur twice or more in
    the text, lines with a word, different words, capitals (A-Z), digits, exclamation and question marks, code points.

    A null text counts as empty. Each row is reckoned by itself, within its row, whatever the length of its text. Windows are compared by 64-bit hashes of their words' hashes, so with n
    words a text has a wrong count with a chance of n * n / 2 ** 65. Other columns are kept, but for those named like new ones.
    """
    kept = [c for c in docs.columns if c not in (*STATISTICS, text)]
    keys = [f"c{i}" for i in range(len(kept))]
    rows = docs.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(kept, keys, strict=True)], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    count = lambda outside: F.length(F.regexp_replace("t", outside, "")).cast("long")
    rows = rows.select(
        *keys, F.array_remove(F.split("t", _SPACE), "").alias("w"), F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        count(_SYMBOLS).alias("n_symbols"), count("[^A-Z]+").alias("n_upper"), count("[^0-9]+").alias("n_digits"), count("[^!?]+").alias("n_marks"), F.length("t").cast("long").alias("n_chars"),
    )
    simple = ["n_symbols", "n_upper", "n_digits", "n_marks", "n_chars"]
    rows = rows.select(
        *keys, *simple, F.size("w").cast("long").alias("n_words"), F.length(F.array_join("w", "")).cast("long").alias("word_chars"), F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), F.transform("w", lambda x: F.xxhash64(x)).alias("h"),
    )
    simple += ["n_words", "word_chars", "n_distinct", "n_lines", "n_dup_lines"]
    # a window's hash from those of its halves, thrice: runs of 2, 4 and 8 words
    for step in (1, 2, 4):
        n = F.greatest(F.size("h") - step, F.lit(0))
        rows = rows.select(*keys, *simple, F.zip_with(F.slice("h", 1, n), F.slice("h", 1 + step, n), lambda a, b: F.xxhash64(a, b)).alias("h"))
    rows = rows.select(*keys, *simple, F.when(F.size(F.array_distinct("h")) < F.size("h"), F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))).alias("h"))
    same = lambda s, i, k: F.coalesce(F.get("h", i + k)["x"] == s["x"], F.lit(False))
    twice = F.filter("h", lambda s, i: same(s, i, -1) | same(s, i, 1))
    rows = rows.select(*keys, *simple, F.sort_array(F.transform(twice, lambda s: s["i"])).alias("at"))
    # each window adds what lies beyond the one before
    more = F.aggregate(F.zip_with(F.slice("at", 1, F.size("at") - 1), F.slice("at", 2, F.size("at") - 1), lambda a, b: F.least(b - a, F.lit(WINDOW))), F.lit(WINDOW), lambda n, d: n + d)
    rows = rows.withColumn("n_repeat_words", F.when(F.col("at").isNotNull(), more).otherwise(0).cast("long"))
    return rows.select(*keys, *STATISTICS).toDF(*kept, *STATISTICS)


def base_failed() -> Column:
    """Whether a row with STATISTICS has too few words or repeats itself too much."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


Rule = list[tuple[str, str, int]]


def condition(rule: Rule) -> Column:
    """A rule as an expression over STATISTICS: all of its (feature, <= or >=, threshold) hold."""
    out = F.lit(True)
    for name, sign, at in rule:
        value = F.expr(FEATURES[name])
        out &= value <= at if sign == "<=" else value >= at
    return out


def verdict(rules: list[Rule]) -> Column:
    """The number (from 1) of the first rule that holds, null if none does: one conditional expression, in the rules' order."""
    out = F.lit(None).cast("int")
    for k, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(condition(rule), k).otherwise(out)
    return out


def learn_rules(labelled: DataFrame, good: str = "good", key: str = "doc_id") -> list[Rule]:
    """Rules for what is bad, from rows with STATISTICS, `good` (boolean) and `key`.

    Sequential covering: on two thirds of the rows (by a hash of the key), a rule grows by the condition that gains most (FOIL), over all features and thresholds, until it covers no good row, has
    CONDITIONS conditions or gains nothing. On the other third it is cut back to the length whose (bad - good) / (bad + good) is greatest, the shortest of several. Rows that it covers leave both parts,
    and the next one grows, until a rule covers too few or too many good rows. Rows that fail the base rules take no part; nor do null labels. Rows with the same key are in the same part. No rows give no
    rules. Each step is one aggregation whose result has a row for each feature and value, at most about 10,000, at any number of labelled rows.
    """
    rows = labelled.where(F.col(good).isNotNull() & ~base_failed()).select(F.xxhash64(key).alias("at"), F.col(good).alias("good"), *STATISTICS)
    total = rows.count()
    share = F.pmod("at", F.lit(1_000_000_007)) <= 1_000_000_007 * min(1.0, SAMPLE_ROWS / max(total, 1))
    values = F.array(*[F.expr(f).cast("int") for f in FEATURES.values()])
    table = written(rows.where(share).select((F.pmod(F.xxhash64("at"), F.lit(3)) > 0).alias("grow"), "good", values.alias("v")), "quality-labels")
    rules: list[Rule] = []
    left = table
    while len(rules) < RULES:
        rule = _grow(left.where("grow"))
        rule = _prune(left.where("not grow"), rule) if rule else None
        if not rule:
            break
        rules.append(rule)
        left = left.where(~_holds(rule))
    discard(table)
    return rules


_PLACE = {name: i for i, name in enumerate(FEATURES)}


def _holds(rule: Rule) -> Column:
    out = F.lit(True)
    for name, sign, at in rule:
        v = F.get("v", F.lit(_PLACE[name]))
        out &= v <= at if sign == "<=" else v >= at
    return out


def _grow(rows: DataFrame) -> Rule:
    rule: Rule = []
    names = list(FEATURES)
    while len(rule) < CONDITIONS:
        seen = rows.where(_holds(rule)).select("good", F.posexplode("v").alias("f", "x")).groupBy("f", "x").agg(F.count_if(~F.col("good")).alias("bad"), F.count_if("good").alias("fine")).collect()
        of: dict[int, list] = {}
        for r in seen:
            of.setdefault(r["f"], []).append((r["x"], r["bad"], r["fine"]))
        if not of:
            break
        bad, fine = (sum(x[k] for x in of[0]) for k in (1, 2))
        if not bad or not fine:
            break
        now, best = log2(bad / (bad + fine)), (0.0, None)
        for f, hist in sorted(of.items()):
            hist.sort()
            b = g = 0
            for (x, db, dg), after in zip(hist, [*hist[1:], None], strict=True):
                b, g = b + db, g + dg
                if after is None:
                    break
                # thresholds stand half-way to the next value that was seen
                mid = (x + after[0]) // 2
                for sign, at, p, n in (("<=", mid, b, g), (">=", mid + 1, bad - b, fine - g)):
                    gain = p * (log2(p / (p + n)) - now) if p else 0.0
                    if gain > best[0] + 1e-9:
                        best = (gain, (names[f], sign, at))
        if best[1] is None:
            break
        rule.append(best[1])
    return rule


def _prune(rows: DataFrame, rule: Rule) -> Rule | None:
    """The best beginning of a rule by rows that it was not grown on; None if that covers too few bad rows, or too many good ones."""
    counts = [F.count_if(_holds(rule[:k]) & (F.col("good") == v)) for k in range(1, len(rule) + 1) for v in (False, True)]
    got = rows.agg(*[c.alias(f"x{i}") for i, c in enumerate(counts)]).first()
    worth = [(-(got[2 * k] - got[2 * k + 1]) / max(got[2 * k] + got[2 * k + 1], 1), k) for k in range(len(rule))]
    k = min(worth)[1]
    bad, fine = got[2 * k], got[2 * k + 1]
    return rule[: k + 1] if bad >= LEAST_COVER and bad >= LEAST_PRECISION * (bad + fine) else None


def quality_rules(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> tuple[DataFrame, list[Rule]]:
    """(docs without the text, with STATISTICS, base_failed, rule and kept; the rules), with rules learned from the docs that labels (doc_id, label: 0 is bad, others are good) name.

    rule is the number of the first rule that holds (null: none); kept is false if base_failed or any rule holds. Texts are read once: their numbers are written, joined with labels and judged.
    Null texts have no words, so they fail; null ids and labels teach nothing; of several labels of an id the least counts; docs that repeat an id are judged each. Without labels there are no rules, and
    an empty table gives no rows. Columns of docs named like new ones are replaced.
    """
    new = (*STATISTICS, "base_failed", "rule", "kept")
    kept = [c for c in docs.columns if c not in (*new, text)]
    own = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], F.col(f"`{text}`").alias("text"))
    key = f"c{kept.index(doc_id)}"
    table = written(statistics(own), "quality-statistics")
    told = labels.where(F.col(f"`{doc_id}`").isNotNull()).groupBy(F.col(f"`{doc_id}`").alias(key)).agg((F.min(F.col(f"`{label}`")) != 0).alias("good"))
    rules = learn_rules(table.select(key, *STATISTICS).join(told, key), "good", key)
    out = table.withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()).toDF(*kept, *new), rules
