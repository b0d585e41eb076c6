"""URL filters: allow and block rules first, then a weighted vocabulary found by Aho-Corasick.

A vocabulary gives terms weights; those of ``reject`` or more are strict, the others soft.  One
automaton finds every occurrence in the lower-cased URL, in which percent-encoded ASCII letters and
digits stand for themselves; an occurrence counts where no ASCII letter or digit touches it.  A URL is
blocked when the weights of its distinct terms add up to ``reject``: by one strict term, or by
several soft ones.  The automaton is built once a task; only the URL column is read.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import OWN

#: The vocabulary.  Terms are lower-case ASCII.
STRICT = (
    "porn porno pornhub pornstar pornstars xxx xxxvideos hentai camgirl camgirls camsex escort escorts milf milfs nsfw onlyfans warez bdsm blowjob creampie cumshot deepthroat "
    "ebony-porn fetish-porn gangbang handjob hardcore-porn hookers incest masturbation orgy rimjob sexcam sexcams sexchat sextube slutty striptease upskirt voyeur whores xvideos xnxx youporn redtube"
).split()
SOFT = (
    "adult adults sex sexy nude nudes naked erotic erotica hot hottest dating hookup singles lingerie swingers webcam webcams casino casinos poker bet bets betting slots slot jackpot roulette blackjack "
    "lottery bingo sportsbook viagra cialis levitra pills pharmacy steroids weed cannabis payday loan loans credit debt bitcoin crypto forex torrent torrents crack cracked cracks keygen serial nulled "
    "pirate free cheap cheapest discount replica rolex giveaway winner prize clickbait"
).split()
STRICT_WEIGHT, SOFT_WEIGHT, REJECT = 2, 1, 2
VOCABULARY = {t: SOFT_WEIGHT for t in SOFT} | {t: STRICT_WEIGHT for t in STRICT}
#: Fixed values: (verdict, host, path) rules; host and all its subdomains, paths that start so; longest host + path wins.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (code, character) of percent-encoded letters and digits in a lower-cased URL, replaced in this order.
_CODES = [(f"%{ord(c):02x}", c.lower()) for c in "0123456789" + _LOWER + _UPPER]


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or url."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://`` or url."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_verdict(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, nulls if none does."""
    rule = verdict = F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1:])):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        rule, verdict = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def term_counts(url: Column, vocabulary: Mapping[str, float] = VOCABULARY, reject: float = REJECT) -> Column:
    """struct(strict long, soft long, weight double): distinct strict and soft terms in the URL, and their weights' sum.  Null counts as empty."""
    terms = dict(vocabulary)

    @F.pandas_udf("strict long, soft long, weight double")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        found = ahocorasick.Automaton()
        for term, weight in terms.items():
            found.add_word(term, (term, weight))
        if terms:
            found.make_automaton()
        edge = set(_LOWER + "0123456789").isdisjoint
        low = str.maketrans(_UPPER, _LOWER)
        for urls in batches:
            rows = []
            for url in urls:
                text = f" {url or ''} ".translate(low)
                if "%" in text:
                    for code, c in _CODES:
                        text = text.replace(code, c)
                hits = {hit for end, hit in found.iter(text) if edge((text[end - len(hit[0])], text[end + 1]))} if terms else ()
                hard = sum(weight >= reject for _, weight in hits)
                rows.append((hard, len(hits) - hard, float(sum(weight for _, weight in hits))))
            yield pd.DataFrame(rows, columns=["strict", "soft", "weight"]).astype({"strict": "int64", "soft": "int64", "weight": "float64"})

    return count(url)


def vocabulary_of(terms: DataFrame, *, term: str = "term", weight: str = "weight", most: int = 100_000) -> dict[str, float]:
    """A vocabulary from a table of terms and weights, for ``filter_urls``.

    Terms are lower-cased; of a term given twice the larger weight counts, and rows without a term or a
    weight do not.  Every task holds the automaton, so more than ``most`` terms are refused.
    """
    low = F.translate(F.col(f"`{term}`").cast("string"), _UPPER, _LOWER)
    rows = terms.select(low.alias("term"), F.col(f"`{weight}`").cast("double").alias("weight")).where("term <> '' and weight is not null")
    found = rows.groupBy("term").agg(F.max("weight").alias("weight")).limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} terms")
    return {r.term: r.weight for r in sorted(found)}


def filter_urls(pages: DataFrame, *, url: str = "url", vocabulary: Mapping[str, float] = VOCABULARY, reject: float = REJECT, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``pages`` and ``url_host``, ``url_path``, ``url_rule``, ``url_strict``, ``url_soft``, ``url_weight``, ``url_verdict``.

    Every row keeps its place, repeated ones too; input columns of these names are replaced, all
    others kept.  A null or empty URL, or one without ``://``, has an empty host and path; the
    vocabulary still reads it.  URLs of any length are read whole.  An empty table gives no rows.
    ``rules`` is a list held in the plan, meant for up to some thousands; of equally long ones that fit
    the last in order of host and path wins.
    """
    own = f"{OWN}terms"
    out = pages.withColumn("url_host", url_host(F.col(f"`{url}`"))).withColumn("url_path", url_path(F.col(f"`{url}`")))
    rule, verdict = rule_verdict(F.col("url_host"), F.col("url_path"), rules)
    counts = F.col(own)
    out = out.withColumn("url_rule", rule).withColumn("url_verdict", verdict).withColumn(own, term_counts(F.col(f"`{url}`"), vocabulary, reject))
    out = out.withColumn("url_strict", counts["strict"]).withColumn("url_soft", counts["soft"]).withColumn("url_weight", counts["weight"]).drop(own)
    return out.withColumn("url_verdict", F.coalesce("url_verdict", F.when(F.col("url_weight") >= reject, "block").otherwise("allow")))


def oracle(pages: str = "pages") -> str:
    """The same verdicts in DuckDB's SQL, term by term."""
    low = f"translate(coalesce(url, ''), '{_UPPER}', '{_LOWER}')"
    for code, c in _CODES:
        low = f"replace({low}, '{code}', '{c}')"
    hit = lambda t: f"regexp_matches(low, '(^|[^a-z0-9]){t}($|[^a-z0-9])')::bigint"
    strict, soft = ([t for t, weight in VOCABULARY.items() if (weight >= REJECT) == hard] for hard in (True, False))
    rest = "case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) end"
    fits = lambda h, p: f"(host = '{h}' or suffix(host, '.{h}')) and prefix(path, '{p}')"
    longest = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    case = lambda value: "case " + " ".join(f"when {fits(h, p)} then '{value(k, h, p)}'" for k, h, p in longest) + " end"
    return f"""
with lowered as (select page_id, url, {low} as low from {pages}),
parts as (
  select page_id, translate(coalesce(regexp_extract({rest}, '^([^/?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') as host,
    coalesce(regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1), '') as path,
    {" + ".join(map(hit, strict))} as strict_terms, {" + ".join(map(hit, soft))} as soft_terms
  from lowered)
select page_id, host, path, {case(lambda k, h, p: h + p)} as rule,
  coalesce({case(lambda k, h, p: k)}, case when {STRICT_WEIGHT} * strict_terms + {SOFT_WEIGHT} * soft_terms >= {REJECT} then 'block' else 'allow' end) as verdict,
  strict_terms, soft_terms
from parts"""
