"""License scans: ordered signature rules behind a keyword filter, with containment suppression.

DataFrame functions only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import NON_WORD, read_table, saved, text_key


@dataclass(frozen=True)
class Rule:
    """A regex over words that are separated by single spaces; a text is tried only if it has ``keyword``."""
    label: str
    keyword: str
    regex: str
    priority: int
    weight: float
    base: bool = False


#: Phrases that are always reported, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Licences: label, a word or phrase that its every mention has, what its name looks like, its versions.
NAMES = [
    ("apache", " apache ", r"apache(?: software)?(?: foundation)?(?: public)? licen[cs]e", ["1.0", "1.1", "2.0"]),
    ("mit", " mit ", r"(?:mit|expat) licen[cs]e", []),
    ("mit-0", " attribution ", r"mit no attribution(?: licen[cs]e)?", []),
    ("bsd", " bsd ", r"bsd(?: style)?(?: licen[cs]e)?", ["0-clause", "1-clause", "2-clause", "3-clause", "4-clause"]),
    ("isc", " isc ", r"isc licen[cs]e", []),
    ("gpl", " general public licen", r"(?:gnu )?general public licen[cs]e", ["1.0", "2.0", "3.0", "1", "2", "3"]),
    ("gpl", " gpl", r"(?:gnu )?gpl(?: licen[cs]e)?", ["1.0", "2.0", "3.0", "v2", "v3", "1", "2", "3"]),
    ("lgpl", " general public licen", r"(?:gnu )?(?:lesser|library) general public licen[cs]e", ["2.0", "2.1", "3.0", "3"]),
    ("lgpl", " lgpl", r"(?:gnu )?lgpl(?: licen[cs]e)?", ["2.0", "2.1", "3.0", "v3", "3"]),
    ("agpl", " affero ", r"(?:gnu )?affero general public licen[cs]e", ["1.0", "3.0", "3"]),
    ("agpl", " agpl", r"(?:gnu )?agpl(?: licen[cs]e)?", ["1.0", "3.0", "v3", "3"]),
    ("gfdl", " free documentation ", r"(?:gnu )?free documentation licen[cs]e", ["1.1", "1.2", "1.3"]),
    ("mpl", " mozilla ", r"mozilla public licen[cs]e", ["1.0", "1.1", "2.0"]),
    ("epl", " eclipse ", r"eclipse public licen[cs]e", ["1.0", "2.0"]),
    ("cddl", " common development ", r"common development and distribution licen[cs]e", ["1.0", "1.1"]),
    ("eupl", " european union ", r"european union public licen[cs]e", ["1.0", "1.1", "1.2"]),
    ("artistic", " artistic ", r"artistic licen[cs]e", ["1.0", "2.0"]),
    ("bsl", " boost ", r"boost software licen[cs]e", ["1.0"]),
    ("zlib", " zlib ", r"zlib(?: libpng)? licen[cs]e", []),
    ("psf", " python ", r"python software foundation licen[cs]e", ["2.0"]),
    ("odbl", " open database ", r"open database licen[cs]e", ["1.0"]),
    ("ofl", " open font ", r"(?:sil )?open font licen[cs]e", ["1.0", "1.1"]),
    ("unlicense", " unlicense ", r"(?:the )?unlicense", []),
    ("wtfpl", " wtfpl ", r"wtfpl", ["1.0", "2.0"]),
    ("cc0", " cc0 ", r"cc0(?: universal)?", ["1.0"]),
    ("cc0", " cc zero ", r"cc zero", ["1.0"]),
]
#: Creative Commons: short forms and the names in full.
COMMONS = {"by": "attribution", "by-sa": "attribution sharealike", "by-nd": "attribution noderiv(?:ative)?s",
           "by-nc": "attribution noncommercial", "by-nc-sa": "attribution noncommercial sharealike",
           "by-nc-nd": "attribution noncommercial noderiv(?:ative)?s"}
NAMES += [(f"cc-{k}", " cc by ", "cc " + k.replace("-", " "), ["2.0", "2.5", "3.0", "4.0"]) for k in COMMONS]
NAMES += [(f"cc-{k}", " creative commons ", f"creative commons {v}(?: international)?", ["2.0", "2.5", "3.0", "4.0"])
          for k, v in COMMONS.items()]

#: Single phrases: label, keyword, regex, priority, weight.
PHRASES = [
    ("grant-mit", " permission is hereby granted ", r"permission is hereby granted free of charge to any person", 3, 1.0),
    ("grant-isc", " permission to use ", r"permission to use copy modify and or distribute this software", 3, 1.0),
    ("grant-bsd", " redistribution and use ", r"redistribution and use in source and binary forms", 3, 1.0),
    ("no-warranty", " as is ", r"provided as is without(?: any)? warrant(?:y|ies)", 2, 0.7),
    ("no-warranty", " without any warranty ", r"but without any warranty", 2, 0.7),
    ("public-domain", " public domain ", r"(?:released|dedicated|placed) (?:in|into|to) the public domain", 3, 0.9),
    ("public-domain", " public domain ", r"public domain", 1, 0.5),
    ("copyright", " copyright ", r"copyright(?: c)?(?: by)?(?: \d{4})+", 2, 0.6),
    ("copyright", " copyright ", r"copyright", 1, 0.4),
    ("copyright", " copyrighted ", r"copyrighted material", 1, 0.5),
    ("proprietary", " proprietary ", r"proprietary and confidential", 2, 0.8),
    ("proprietary", " unauthorized ", r"unauthorized (?:copying|use|reproduction|distribution)(?: of this)?", 2, 0.8),
    ("reserved", " rights reserved ", r"(?:some|no) rights reserved", 2, 0.6),
    ("license-file", " license file ", r"see (?:the )?(?:accompanying )?license file", 1, 0.5),
    ("licensed", " licensed ", r"licensed (?:under|to)", 1, 0.4),
    ("licensed", " released ", r"released under (?:the|a) licen[cs]e", 1, 0.4),
    ("commons", " creative commons ", r"creative commons(?: licen[cs]e)?", 1, 0.5),
]
#: How a licence is granted, which outranks the mere name.
GRANT = (r"(?:licensed|released|distributed|available|published|provided|covered) (?:under|by) (?:the )?"
         r"(?:terms (?:and conditions )?of (?:the )?)?")


def license_rules() -> list[Rule]:
    """All rules: base phrases, phrases, and for each licence and version its grant, its SPDX tag and its name."""
    rules = [Rule(label, f" {p} ", p, 0, 0.6, True) for p, label in BASE.items()]
    rules += [Rule(*p) for p in PHRASES]
    for label, keyword, name, versions in NAMES:
        for version in [None, *versions]:
            full = name if version is None else name + r"(?: version| v)? " + version.lower().replace(".", " ").replace("-", " ")
            tag = label if version is None else f"{label}-{version.removeprefix('v')}"
            spdx = (tag.replace("-", " ").replace(".", " "))
            rules.append(Rule(tag, keyword, GRANT + full, 3, 1.0))
            rules.append(Rule(tag, keyword, full, 2, 0.8))
            rules.append(Rule(tag, " spdx ", r"spdx license identifier " + spdx, 3, 1.0))
    return list(dict.fromkeys(rules))


#: Parts of words, one of which is in whatever a rule matches: a text without any of them is not looked at.
ROOTS = ["licen", "gpl", "copyright", "rights reserved", " cc", "bsd", "public domain", "creative commons", "warrant",
         "permission", "redistribution", "proprietary", "unauthorized", "attribution", "wtfpl"]


def root(rule: Rule) -> str:
    """The first of ROOTS that the rule's keyword, or its regex outside optional groups, holds; else the keyword."""
    fixed, before = rule.regex, None
    while fixed != before:
        fixed, before = re.sub(r"\(\?:[^()]*\)\?", "", fixed), fixed
    fixed = re.sub(r"\(\?:[^()]*\)", "#", fixed)
    return next((r for r in ROOTS if r in rule.keyword or r in f" {fixed} "), rule.keyword)


def spaced(text: Column) -> Column:
    """The text's words, lowered, each between single spaces."""
    return F.concat(F.lit(" "), F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), NON_WORD, " "))), F.lit(" "))


MARK = "\u0001"


def detections(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """(key, rule, label, priority, weight, base, start, stop): every match of every rule, in words of the text.

    A text is looked at only if it holds some rule's root, and a rule is tried
    only on texts that hold its keyword.  The words where a rule matches are
    marked by a character that no word has; their places are the starts.
    """
    keywords = list(dict.fromkeys(map(root, rules)))
    # Bound to a variable, the words are made once a text; a plain filter would make them again for each keyword.
    some = F.exists(F.array(spaced(F.col("text"))), lambda n: reduce(or_, [F.contains(n, F.lit(k)) for k in keywords]))
    table = F.array(*[F.struct(
        F.lit(i).alias("rule"), F.lit(r.label).alias("label"), F.lit(r.keyword).alias("keyword"),
        F.lit(f"(?<= )(?:{r.regex})(?= )").alias("regex"), F.lit(r.priority).alias("priority"),
        F.lit(r.weight).alias("weight"), F.lit(r.base).alias("base")) for i, r in enumerate(rules)])
    texts = docs.where(some).select(text_key(F.col("text")).alias("key"), spaced(F.col("text")).alias("norm"))
    tried = F.filter(table, lambda r: F.when(F.contains(F.col("norm"), r["keyword"]), F.rlike(F.col("norm"), r["regex"])))
    hits = texts.select("key", "norm", F.explode(tried).alias("r"))
    marked = F.split(F.regexp_replace("norm", F.col("r.regex"), F.lit(MARK + "$0")), " ")
    starts = F.filter(F.transform(marked, lambda w, i: F.when(w.startswith(MARK), i - 1)), lambda i: i.isNotNull())
    sizes = F.transform(F.regexp_extract_all("norm", F.col("r.regex"), F.lit(0)), lambda m: F.size(F.split(m, " ")))
    spans = F.explode(F.arrays_zip(starts.alias("start"), sizes.alias("size"))).alias("s")
    rows = hits.select("key", "r", spans)
    return rows.select("key", "r.rule", "r.label", "r.priority", "r.weight", "r.base", F.col("s.start").cast("long").alias("start"),
                       (F.col("s.start") + F.col("s.size")).cast("long").alias("stop")).distinct()


def resolve(found: DataFrame, priorities: int = 4) -> DataFrame:
    """``found`` with ``kept``: false if its span lies in another's of the same or a higher priority.

    Of equal spans the higher priority is kept, then the earlier rule.  What
    contains a span stands before it by (start, stop descending), so the
    largest stop so far of each priority decides; base phrases stay.
    """
    before = Window.partitionBy("key").orderBy("start", F.desc("stop"), F.desc("priority"), "rule").rowsBetween(
        Window.unboundedPreceding, -1)
    inside = F.lit(False)
    for p in range(priorities):
        reach = F.max(F.when(F.col("priority") >= p, F.col("stop"))).over(before)
        inside = inside | ((F.col("priority") == p) & F.coalesce(reach >= F.col("stop"), F.lit(False)))
    return found.withColumn("kept", F.col("base") | ~inside)


def scan_licenses(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """(doc_id, n_words, detections summary) for every row of ``docs`` (doc_id, text).

    ``n_base`` counts all places of base phrases, ``first_word`` and
    ``last_word`` are their smallest and largest starts (NULL if none),
    ``base_labels`` and ``labels`` the distinct sorted labels of base phrases
    and of all kept detections, ``score`` the largest weight of those, 0
    without.  NULL text has no words.  Copies of a text share its detections;
    ids may repeat or be NULL.
    """
    kept = resolve(detections(docs, rules or license_rules())).where("kept")
    base = F.when(F.col("base"), F.col("start"))
    per = kept.groupBy("key").agg(
        F.count(base).alias("n_base"), F.min(base).alias("first_word"), F.max(base).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"), F.max("weight").alias("score"))
    per = saved(per, "licenses")
    words = F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), NON_WORD), "")).cast("long")
    rows = docs.select("doc_id", text_key(F.col("text")).alias("key"), words.alias("n_words"))
    none, zero = F.lit(""), F.lit(0)
    return rows.join(per, "key", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", zero.cast("long")).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", none).alias("base_labels"), F.coalesce("labels", none).alias("labels"),
        F.coalesce("score", zero.cast("double")).alias("score"))


def op7_licenses(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))
