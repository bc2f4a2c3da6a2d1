"""URL filters: rules by host and path, and where none fits a logistic regression on hashed character n-grams.

All that runs on the pages are Spark functions. The labelled table is small; its hashed n-grams are found by the same
expression and the weights fitted from them on the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ALLOW, BLOCK = "allow", "block"
DIM = 1 << 12
MAX_LABELLED = 20_000
_ORDERS = (3, 4, 5)
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Words of hosts in the small labelled table. Those to be blocked are of gambling, pornography, medicine sold
# by mail, fraud, pirated software and advertising; the others are plain nouns from many fields.
_BLOCKED = "adult ads adserver advert banner bet bets betting bingo bitcoinbonus bonus cam cams casino cheap cialis clickbait clicker coupon crack cracked "
_BLOCKED += "dating discount erotic escort escorts fake free freebie gambler gambling hacked hentai hotgirls jackpot keygen loan loans lottery lotto malware "
_BLOCKED += "naked nude payday phish pharmacy pills piracy poker popunder popup porn porno promo replica riches roulette scam sex sexy slots spam spammer "
_BLOCKED += "spyware swinger torrent track tracker tracking traffic viagra virus warez webcam win winner xrated xxx"
_ALLOWED = "academy airport album alphabet animal apple archive art athlete atlas author autumn bakery balance ballet bank bay beach bear bell bicycle biology bird "
_ALLOWED += "blossom boat book border botany bottle bread bridge bronze brother building butter cabin camera canal candle captain carpet castle cathedral cedar "
_ALLOWED += "census chapter cheese chemistry chess child choir church cinema circle city climate clinic clock cloud coast coffee college comet concert cooking "
_ALLOWED += "copper coral cotton council country course court culture daily dance daughter debate desert design dictionary doctor dolphin drawing earth east "
_ALLOWED += "economy editor election energy engine essay evening express fabric factory family farm father feather festival field film finance flower forest "
_ALLOWED += "fountain friend gallery garden gazette geography glass grammar granite guitar harbor harvest health herald history holiday home honey horizon "
_ALLOWED += "horse hospital house industry iron island journal judge kitchen lake lamp language law leather lecture letter library light lighthouse lion "
_ALLOWED += "literature machine magazine map maple marble market math meadow medicine meeting member memory mineral minister mirror monument moon morning "
_ALLOWED += "mother mountain museum music nation nature needle news north notebook novel number ocean office olive opera orchard orchestra organ painting "
_ALLOWED += "palace paper parliament peace pencil people physics piano planet poem police pottery prairie press professor province question quilt radio railway "
_ALLOWED += "rain recipe record region research river road robin room salmon school science sculpture season senate shelter shepherd sister sky society soil "
_ALLOWED += "soldier song source south spring station stone story street student summer sun surgeon teacher temple theater thesis thread tower town trade "
_ALLOWED += "tradition travel treaty tree tribune tulip tunnel university valley village violin vision voice volcano wagon walk water weather wheat window "
_ALLOWED += "winter witness woman wood wool word workshop world writer yard year zoo"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    def __str__(self) -> str:
        return self.host + self.path


def parse_rule(line: str) -> Rule:
    """A rule as ``block example.org/en/``."""
    verdict, _, place = line.partition(" ")
    host, slash, path = place.partition("/")
    if verdict not in (ALLOW, BLOCK) or not host:
        raise ValueError(f"not a rule: {line!r}")
    return Rule(host.translate(str.maketrans(_CAPITALS, _SMALL)), slash + path, verdict)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, small letters, and path of a url; both empty where it is null or has no ``://``."""
    pattern = r"(?s)://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, pattern, i), F.lit("")) for i in (1, 2))
    return F.translate(host, _CAPITALS, _SMALL), path


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule for a host (or a host above it) and a path's start: a struct (rule, verdict), or null.

    Of rules equally long the one with the longer host counts, then the later in the alphabet. Rules are looked up by
    each suffix of the host, so that a page costs its labels, not the number of rules.
    """
    kind = "struct<size:int,host:int,rule:string,verdict:string,path:string>"
    if not rules:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    by_host: dict[str, list[Rule]] = {}
    for rule in rules:
        by_host.setdefault(rule.host, []).append(rule)
    entries = []
    for name, own in by_host.items():
        rows = [F.struct(F.lit(len(str(r))).alias("size"), F.lit(len(r.host)).alias("host"), F.lit(str(r)).alias("rule"), F.lit(r.verdict).alias("verdict"), F.lit(r.path).alias("path")) for r in own]
        entries += [F.lit(name), F.array(*rows)]
    table = F.create_map(*entries)
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    known = F.flatten(F.transform(suffixes, lambda s: F.coalesce(F.try_element_at(table, s), F.array().cast(f"array<{kind}>"))))
    best = F.array_max(F.filter(known, lambda r: F.startswith(path, r["path"])))
    return F.when(best.isNotNull(), F.struct(best["rule"].alias("rule"), best["verdict"].alias("verdict")))


def _place(kind: str):
    return lambda gram: F.pmod(F.xxhash64(F.concat(F.lit(kind), gram)), F.lit(DIM)).cast("int")


def grams(host: Column, path: Column) -> Column:
    """The distinct hashed character n-grams of a host and a path, which don't share places, as an array of 0 .. DIM-1."""
    parts = []
    for kind, text in (("h", host), ("p", path)):
        framed = F.concat(F.lit("^"), text, F.lit("$"))
        for n in _ORDERS:
            found = F.regexp_extract_all(framed, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))
            parts.append(F.transform(found, _place(kind)))
    return F.array_distinct(F.concat(*parts))


def labelled_urls(spark: SparkSession, blocked: str = _BLOCKED, allowed: str = _ALLOWED) -> DataFrame:
    """The small labelled table (url, blocked) that comes with the library, from its words or others."""
    rows = []
    for words, label in ((blocked.split(), True), (allowed.split(), False)):
        for i, word in enumerate(words):
            other, top = words[(7 * i + 3) % len(words)], ("com", "net", "org")[i % 3]
            hosts = [f"www.{word}-{other}.example.{top}", f"{('', 'blog.', 'm.')[i % 3]}{word}.example.{top}", f"{word}{other}.example.{top}"]
            # Either class has every path, so that paths teach little; the rarer class has more of them.
            for host in hosts:
                for k in range(3 if label else 2):
                    path = f"/{('en', 'de', 'fr', 'es')[(i + 2 * k) % 4]}/{(i * 2 + k) * 1237 % 50_000}{('/', '.html')[k % 2]}"
                    rows.append((f"https://{host}{path}", label))
    lines = [F.struct(F.lit(url).alias("url"), F.lit(label).alias("blocked")) for url, label in rows]
    return spark.range(1).select(F.inline(F.array(*lines)))


def fit(labelled: DataFrame, url_col: str = "url", label_col: str = "blocked", rounds: int = 10, penalty: float = 1e-3) -> list[float]:
    """Weights of a logistic regression, the constant last, by stochastic gradients in a fixed order.

    The table must be small: more than ``MAX_LABELLED`` rows are refused. Rows without a label teach nothing; no rows
    give weights of zero, which allow everything.
    """
    host, path = host_and_path(F.col(url_col))
    rows = labelled.where(F.col(label_col).isNotNull()).select(F.col(url_col).alias("url"), F.col(label_col).cast("boolean").alias("blocked"), grams(host, path).alias("grams"))
    rows = rows.limit(MAX_LABELLED + 1).collect()
    if len(rows) > MAX_LABELLED:
        raise ValueError(f"more than {MAX_LABELLED} labelled urls")
    rows = sorted((r.url or "", r.blocked, r.grams) for r in rows)
    weights, seen = [0.0] * (DIM + 1), [1e-8] * (DIM + 1)
    for turn in range(rounds):
        for k in range(len(rows)):
            _, blocked, places = rows[(k * 7919 + turn) % len(rows)]
            scale = 1 / math.sqrt(len(places) or 1)
            error = 1 / (1 + math.exp(-weights[DIM] - scale * sum(weights[p] for p in places))) - blocked
            for p, x in [*((p, scale) for p in places), (DIM, 1.0)]:
                slope = error * x + penalty * weights[p]
                seen[p] += slope * slope
                weights[p] -= 0.5 * slope / math.sqrt(seen[p])
    return [round(w, 9) for w in weights]


def blocked_share(host: Column, path: Column, weights: list[float]) -> Column:
    """The probability that a url is to be blocked."""
    table = F.lit(weights[:-1])
    found = grams(host, path)
    total = F.aggregate(found, F.lit(0.0), lambda s, g: s + F.element_at(table, g + 1))
    return 1 / (1 + F.exp(-(F.lit(weights[-1]) + total / F.sqrt(F.greatest(F.size(found), F.lit(1)).cast("double")))))


def judge(pages: DataFrame, rules: list[Rule], weights: list[float], url_col: str = "url", least: float = 0.5) -> DataFrame:
    """``pages`` with a struct ``judged`` (host, path, rule, verdict, share): the longest fitting rule's verdict, or
    where none fits (rule null) ``block`` if the probability to be blocked is over ``least``, else ``allow``.

    Null urls and those without ``://`` have an empty host and path, which the model judges like any other. Rows are
    independent of each other; nothing is shuffled.
    """
    host, path = host_and_path(F.col(url_col))
    parts = pages.withColumn("judged", F.struct(host.alias("host"), path.alias("path")))
    host, path = F.col("judged.host"), F.col("judged.path")
    fitting, share = fitting_rule(host, path, rules), blocked_share(host, path, weights)
    parts = parts.withColumn("judged", F.struct(host.alias("host"), path.alias("path"), fitting.alias("fit"), share.alias("share")))
    own = F.when(F.col("judged.share") > least, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return parts.withColumn(
        "judged",
        F.struct(
            F.col("judged.host").alias("host"),
            F.col("judged.path").alias("path"),
            F.col("judged.fit.rule").alias("rule"),
            F.coalesce(F.col("judged.fit.verdict"), own).alias("verdict"),
            F.col("judged.share").alias("share"),
        ),
    )
