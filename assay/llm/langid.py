"""Language of web pages: text likelihood, declared language, address and host priors, fused by Bayes' rule."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from assay.llm.urls import domain_of, host_of, path_of, suffix_of
from assay.llm.words import as_bytes, byte_runs, runs
from assay.session import materialise

BUCKETS = 1 << 13
FULL_TRIGRAMS = 200  # evidence of a longer text is scaled down to so many trigrams
STRENGTH = 5.0  # pages that a prior counts as
_HIDDEN = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")
_LANG = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<html\b[^>]*?\blang\s*=\s*[\"']?\s*(?P<lang>[a-z]{2,3})\b")
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def declared_language(html: str) -> str | None:
    """Language of the first html tag that names one, wherever it stands outside comments, scripts and styles."""
    return next((m["lang"].lower() for m in _LANG.finditer(html) if m["lang"]), None)


def trigrams(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each byte trigram of the joined texts, start of each text's trigrams and the end)."""
    joined = _FOLD[np.frombuffer(b"  ".join(raws) + b"   ", np.uint8)].astype(np.uint32)
    code = joined[:-2] << 16 | joined[1:-1] << 8 | joined[2:]
    bucket = (code * np.uint32(2654435761) >> np.uint32(19)).astype(np.int32)
    return bucket, np.concatenate([[0], np.cumsum([len(r) + 2 for r in raws])])


def text_model(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages, log-likelihood by language and trigram bucket) from counts over every labelled document.

    Each task counts its own documents; what is shuffled is a row per task, language and bucket. Null texts
    and languages count nothing. Every language that occurs is modelled, with BUCKETS values each.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch["lang"].to_numpy()
            for a, b, raws in byte_runs(batch["text"]):
                bucket, starts = trigrams(raws)
                for lang in set(langs[a:b]):
                    own = np.concatenate([bucket[x:y] for x, y, other in zip(starts[:-1], starts[1:], langs[a:b]) if other == lang])
                    total[lang] = total.get(lang, 0) + np.bincount(own, minlength=BUCKETS)
        for lang, n in total.items():
            some = np.flatnonzero(n)
            yield pd.DataFrame({"lang": lang, "bucket": some, "n": n[some]})

    rows = docs.select(F.lower(F.trim(F.col(lang_col))).alias("lang"), F.col(text_col).alias("text")).filter("lang is not null and text is not null")
    counted = materialise(rows.mapInPandas(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    langs = sorted(r.lang for r in counted.select("lang").distinct().collect())
    table = np.full((len(langs), BUCKETS), 0.5)
    place = {lang: i for i, lang in enumerate(langs)}
    # One row a language; a row is a few tens of kilobytes.
    cells = counted.groupBy("lang").agg(F.collect_list("bucket").alias("buckets"), F.collect_list("n").alias("counts"))
    for r in cells.toLocalIterator():
        table[place[r.lang], r.buckets] += np.array(r.counts)
    return langs, np.log(table / table.sum(1, keepdims=True)).astype(np.float32)


def page_evidence(pages: DataFrame, model: tuple[list[str], np.ndarray], id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(id, url, declared, loglik): declared markup language and scaled text log-likelihood by language."""
    langs, table = model

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            html = [h if isinstance(h, str) else "" for h in batch["html"]]
            for a, b in runs(html):
                raws = as_bytes([_HIDDEN.sub(" ", h) for h in html[a:b]])
                bucket, starts = trigrams(raws)
                total = np.stack([np.add.reduceat(t[bucket], starts[:-1]) for t in table], 1) if len(langs) else np.zeros((b - a, 0))
                size = np.array([len(r.split()) and len(r) for r in raws])
                total = np.where(size[:, None] > 0, total * np.minimum(1, FULL_TRIGRAMS / np.maximum(size, 1))[:, None], 0.0)
                yield pd.DataFrame({
                    "id": batch["id"].iloc[a:b].to_numpy(), "url": batch["url"].iloc[a:b].to_numpy(),
                    "declared": [declared_language(h) for h in html[a:b]], "loglik": list(total),
                })

    rows = pages.select(F.col(id_col).cast("string").alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return rows.mapInPandas(work, "id string, url string, declared string, loglik array<double>")


def _by_language(tally: DataFrame, keys: list[str], n: int, name: str) -> DataFrame:
    """One row per ``keys`` with the array of its counts by language, from rows (keys, t, n); a null t counts as none."""
    cells = tally.groupBy(*keys, "t").agg(F.sum("n").cast("double").alias("n"))
    pairs = F.collect_list(F.when(F.col("t").isNotNull(), F.struct("t", "n")))
    held = cells.groupBy(*keys).agg(F.map_from_entries(pairs).alias("held"))
    filled = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.coalesce(F.try_element_at("held", i), F.lit(0.0)))
    return held.select(*keys, filled.alias(name))


def _shrunk(counts: Column, prior: Column) -> Column:
    """Language shares from counts that start from a prior worth STRENGTH pages."""
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(counts, prior, lambda n, p: (n + STRENGTH * p) / (total + STRENGTH))


def identify(
    pages: DataFrame, docs: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """(id, language, posterior, text_language, declared_language) per page.

    The text likelihood comes from byte trigrams of documents of known language. The declared language of the
    markup and the language code at the start of the path are evidence by how often each value meets each
    text language over all pages. The prior is the page's host's share of languages, shrunk to its registered
    domain's, that to its suffix's, that to the share over all pages; shares are grouped counts of text
    languages. A host without pages of known text language has its domain's share, and so on. All parts add
    up as logarithms.

    A page without words has no text evidence; text_language is null then, and such pages count towards no
    share. Null html or url mean no text and no markup, or no host. Rows that repeat an id each come back;
    ids may be null. Other columns are ignored. Without any document of known language every language is
    null; an empty table gives an empty result.
    """
    model = text_model(docs, text_col, lang_col)
    langs = model[0]
    url = F.col("url")
    best = F.array_position(F.col("loglik"), F.array_max("loglik")).cast("int") - 1
    known = F.exists("loglik", lambda x: x != 0) if langs else F.lit(False)
    code = F.regexp_extract(path_of(url), r"^/([A-Za-z]{2})(?:/|$)", 1)
    evidence = page_evidence(pages, model, id_col, url_col, html_col)
    seen = materialise(evidence.select(
        F.col("id").cast(pages.schema[id_col].dataType).alias("id"), "declared", "loglik", host_of(url).alias("host"), F.lower(code).alias("code"),
        F.when(known, best).alias("t"),
    ))
    if not langs:
        none = F.lit(None).cast("string")
        return seen.select(F.col("id").alias(id_col), none.alias("language"), F.lit(None).cast("double").alias("posterior"), none.alias("text_language"), F.col("declared").alias("declared_language"))

    n = len(langs)
    flat = F.array_repeat(F.lit(1.0 / n), n)
    spoken = seen.filter("t is not null")
    # Hosts without text languages are counted too, with none, so that their domains' and suffixes' shares reach them.
    tally = seen.groupBy("host", "t").agg(F.count(F.lit(1)).alias("n"))
    tally = materialise(tally.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host"))))
    hosts = _by_language(tally, ["host", "domain"], n, "n_host")
    domains = _by_language(tally, ["domain", "suffix"], n, "n_domain")
    suffixes = _by_language(tally, ["suffix"], n, "n_suffix")
    overall = _by_language(tally, [], n, "n_all").select(_shrunk(F.col("n_all"), flat).alias("p_all"))
    # One row; the whole table of suffixes meets it.
    of_suffix = suffixes.crossJoin(F.broadcast(overall)).select("suffix", _shrunk(F.col("n_suffix"), F.col("p_all")).alias("p_suffix"))
    of_domain = domains.join(of_suffix, "suffix").select("domain", _shrunk(F.col("n_domain"), F.col("p_suffix")).alias("p_domain"))
    of_host = materialise(hosts.join(of_domain, "domain").select("host", _shrunk(F.col("n_host"), F.col("p_domain")).alias("p_host")))

    def chances(column: str) -> DataFrame:
        """Chance of each value of a column under each language; written, one row a value."""
        met = materialise(spoken.filter(F.col(column).isNotNull()).groupBy(column, "t").agg(F.count(F.lit(1)).alias("n")))
        rows = _by_language(met, [column], n, "n")
        total = _by_language(met, [], n, "total").crossJoin(met.agg(F.countDistinct(column).alias("values")))
        share = F.zip_with("n", "total", lambda a, b: (a + 0.5) / (b + 0.5 * (F.col("values") + 1)))
        return materialise(rows.crossJoin(F.broadcast(total)).select(column, share.alias(f"p_{column}")))

    joined = seen.join(of_host, "host", "left").join(chances("declared"), "declared", "left").join(chances("code"), "code", "left").crossJoin(F.broadcast(overall))
    neutral = F.array_repeat(F.lit(1.0), n)
    parts = F.arrays_zip(
        F.col("loglik").alias("text"), F.coalesce("p_host", "p_all").alias("host"),
        F.coalesce("p_declared", neutral).alias("declared"), F.coalesce("p_code", neutral).alias("code"),
    )
    score = F.transform(parts, lambda x: x["text"] + F.log(x["host"]) + F.log(x["declared"]) + F.log(x["code"]))
    scored = joined.withColumn("score", score).withColumn("top", F.array_max("score"))
    weight = F.aggregate("score", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    names = F.array(*[F.lit(x) for x in langs])
    return scored.select(
        F.col("id").alias(id_col), F.get(names, F.array_position("score", F.col("top")).cast("int") - 1).alias("language"),
        (1 / weight).alias("posterior"), F.get(names, F.col("t")).alias("text_language"), F.col("declared").alias("declared_language"),
    )
