"""License scan with ordered signature rules, in DataFrame functions only.

A rule's pattern is tried only in texts that hold its keyword. All its places become intervals of
the lower-cased text. An interval that lies within one of a rule of the same or a better tier is
dropped, the first rule's of equal ones stays: "licensed under the Apache License, Version 2.0"
leaves the notice and not the name inside it. Intervals are put in order of their start, longer ones
first; then one pass with the furthest end per tier decides, so many intervals cost no more than
their sort. Nothing is shuffled, texts are read once.

Beside the rules there is a base of three phrases, counted word by word.

Defined cases: a null text is an empty one: no words, no labels, score 0. Repeated rows are judged
alike. Words are runs of letters, digits and non-ASCII.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirstone.llm.license_rules import CONFIDENCE, HINT, NAME, NOTICE, build_rules

# Phrases of the base and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DETECTION = "struct<start:int,stop:int,tier:int,rule:int,label:string>"


def _phrase(*phrases: str) -> str:
    return f"(?<!{WORD})(?:{'|'.join(p.replace(' ', GAP) for p in phrases)})(?!{WORD})"


def _words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"{WORD}+")).cast("long")


def detections(low: Column) -> Column:
    """All intervals of all rules in a lower-cased text, before any is dropped."""
    by_keyword: dict[str, list[dict]] = {}
    for number, rule in enumerate(build_rules()):
        by_keyword.setdefault(rule.keyword, []).append({"pattern": rule.pattern, "tier": rule.tier, "rule": number, "label": rule.label})
    table = F.from_json(F.lit(json.dumps(by_keyword, ensure_ascii=False)), "map<string,array<struct<pattern:string,tier:int,rule:int,label:string>>>")
    keywords = F.array(*(F.lit(k) for k in by_keyword))
    present = F.filter(keywords, lambda k: F.contains(low, k))

    def places(rule: Column) -> Column:
        """Text between the places and the places themselves add up to their positions."""
        between = F.split(low, rule["pattern"], -1)
        found = F.regexp_extract_all(low, rule["pattern"], F.lit(0))
        steps = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda b, m: F.struct(F.length(b).alias("before"), F.length(m).alias("size")))
        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{DETECTION}>").alias("list"))

        def add(done: Column, step: Column) -> Column:
            begin = done["at"] + step["before"]
            place = F.struct(begin.alias("start"), (begin + step["size"]).alias("stop"), rule["tier"].alias("tier"), rule["rule"].alias("rule"), rule["label"].alias("label"))
            return F.struct((begin + step["size"]).alias("at"), F.concat(done["list"], F.array(place)).cast(f"array<{DETECTION}>").alias("list"))

        return F.aggregate(steps, start, add)["list"]

    rules = F.flatten(F.transform(present, lambda k: F.element_at(table, k)))
    none = F.array().cast(f"array<{DETECTION}>")
    return F.when(F.size(present) > 0, F.flatten(F.transform(rules, places))).otherwise(none)


def resolve(found: Column) -> Column:
    """Drop every interval that lies within one of the same or a better tier."""
    ordered = F.array_sort(
        F.transform(found, lambda d: F.struct(d["start"].alias("start"), (-d["stop"]).alias("minus"), d["tier"].alias("tier"), d["rule"].alias("rule"), d["label"].alias("label")))
    )
    tiers = (NOTICE, NAME, HINT)
    start = F.struct(*(F.lit(-1).alias(f"end{t}") for t in tiers), F.array().cast(f"array<{DETECTION}>").alias("list"))

    def judge(done: Column, d: Column) -> Column:
        stop = -d["minus"]
        reach = F.greatest(done["end0"], F.when(d["tier"] >= NAME, done["end1"]).otherwise(F.lit(-1)), F.when(d["tier"] >= HINT, done["end2"]).otherwise(F.lit(-1)))
        place = F.struct(d["start"].alias("start"), stop.alias("stop"), d["tier"].alias("tier"), d["rule"].alias("rule"), d["label"].alias("label"))
        kept = F.when(reach >= stop, done["list"]).otherwise(F.concat(done["list"], F.array(place)))
        ends = [F.when(d["tier"] == t, F.greatest(done[f"end{t}"], stop)).otherwise(done[f"end{t}"]).alias(f"end{t}") for t in tiers]
        return F.struct(*ends, kept.cast(f"array<{DETECTION}>").alias("list"))

    return F.aggregate(ordered, start, judge)["list"]


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: words, base places, labels, score and the resolved detections."""
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    any_phrase = F.lit(_phrase(*BASE))
    gate = F.contains("low", F.lit("cc")) | F.contains("low", F.lit("license")) | F.contains("low", F.lit("reserved"))
    by_label = {label: F.when(gate, F.regexp_count("low", F.lit(_phrase(phrase)))).otherwise(F.lit(0)).cast("long") for phrase, label in BASE.items()}
    columns = docs.select(F.col(key).alias("k"), low.alias("low"))
    counted = columns.select("k", "low", _words(F.col("low")).alias("n_words"), *(c.alias(f"n_{i}") for i, c in enumerate(by_label.values())), resolve(detections(F.col("low"))).alias("found"))
    n_base = sum((F.col(f"n_{i}") for i in range(1, len(by_label))), F.col("n_0"))
    last = F.element_at(F.regexp_extract_all("low", any_phrase, F.lit(0)), -1)
    pieces = F.split("low", any_phrase, -1)
    base_labels = F.array_compact(F.array(*(F.when(F.col(f"n_{i}") > 0, F.lit(label)) for i, label in enumerate(by_label))))
    labels = F.array_sort(F.array_union(base_labels, F.transform("found", lambda d: d["label"])))
    sure = F.array(*(F.lit(c) for c in CONFIDENCE))
    score = F.greatest(F.coalesce(F.array_max(F.transform("found", lambda d: F.element_at(sure, d["tier"] + 1))), F.lit(0.0)), F.when(n_base > 0, F.lit(CONFIDENCE[NAME])).otherwise(F.lit(0.0)))
    return counted.select(
        F.col("k").alias(key),
        "n_words",
        n_base.alias("n_base"),
        F.when(n_base > 0, _words(F.get(pieces, F.lit(0)))).alias("first_word"),
        F.when(n_base > 0, F.col("n_words") - _words(F.element_at(pieces, -1)) - _words(last)).alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        score.alias("score"),
        F.col("found").alias("detections"),
    )
