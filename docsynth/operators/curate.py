"""Dataset curation: keep-lists, incremental work, triples, mirrors, pass rates, lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_list(items: DataFrame, reviewed: DataFrame, stem: str) -> DataFrame:
    """Items whose stem was reviewed."""
    return items.join(reviewed.select(stem), stem, "left_semi")


def removed(items: DataFrame, reviewed: DataFrame, stem: str) -> DataFrame:
    return items.join(reviewed.select(stem), stem, "left_anti")


def incremental_todo(names: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Distinct names not handled yet; copies are merged map-side before the join."""
    return names.select(key).distinct().join(done.select(key), key, "left_anti")


def assemble_triples(composites: DataFrame, masks: DataFrame, reals: DataFrame, split: DataFrame) -> DataFrame:
    """``composite`` names a_b_c.ext of the split list with mask a_b.* and real a.*."""
    bare = F.regexp_replace("composite", r"\.[^.]*$", "")
    keyed = composites.join(split, "composite", "left_semi").select(
        "composite",
        F.regexp_replace(bare, "_[^_]*$", "").alias("mask_key"),
        F.regexp_replace(bare, "_[^_]*_[^_]*$", "").alias("real_key"),
    )
    return keyed.join(masks, "mask_key").join(reals, "real_key").select("composite", "mask", "real")


def mirror_groups(urls: DataFrame, url: str) -> DataFrame:
    """Distinct addresses per file name: how many, and the first. Members stay rows, a popular name is only counted."""
    name = F.substring_index(F.regexp_replace(url, r"[?#].*$", ""), "/", -1)
    members = urls.select(name.alias("name"), F.col(url).alias("url")).distinct()
    return members.groupBy("name").agg(F.count(F.lit(1)).alias("n_urls"), F.min("url").alias("first_url"))


def pass_rate(df: DataFrame, by: str, attempt: Column) -> DataFrame:
    """Share of rows on which a ``try_*`` expression gives a value."""
    failed = F.sum(F.when(attempt.isNull(), 1).otherwise(0))
    total = F.count(F.lit(1))
    return df.groupBy(by).agg(failed.alias("errors"), total.alias("total"), (1 - failed / total).alias("score"))


def dictionary_lookup(df: DataFrame, key: str, table: dict[str, str], out: str, strict: bool = False) -> DataFrame:
    """Translate by a fixed short list; unknown keys stay as they are, or stop the job when ``strict``."""
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    found = F.element_at(pairs, F.col(key))
    if strict:
        return df.withColumn(out, F.coalesce(found, F.raise_error(F.concat(F.lit("no entry for "), F.col(key)))))
    return df.withColumn(out, F.coalesce(found, F.col(key)))
