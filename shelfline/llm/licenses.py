"""License scans by ordered signature rules, with DataFrame functions only.

A text is reduced to its words. Rules are regular expressions over the words joined
by single spaces, each gated by a keyword that must occur first. Every match is a
detection with an interval; a detection whose interval lies inside that of another
with the same or a better priority is suppressed, and the rest give the labels.

Defined cases: a null or empty text has no words and no detections; a text of any
length is scanned whole, and its detections are rows of their own, so that neither
long texts nor many matches are quadratic; equal intervals and priorities keep the
rule that comes first; repeated rows are scanned each; extra columns do no harm; an
empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import let, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The same words as [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ gives; a class of ranges is much
# faster than the complement of a class.
WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"

# The phrases every scan reports, and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Names of licenses as they stand in texts reduced to words, the label
# each gives, and the keyword without which none of its rules is tried.
LICENSE = "(?:public )?licen[cs]e"
VERSION = "(?:,? ?(?:version|ver|v))? ?"
NAMES = (
    ("mit", " mit ", f"mit(?: style)? {LICENSE}"),
    ("mit", " expat ", f"expat {LICENSE}"),
    ("x11", " x11 ", f"x11 {LICENSE}"),
    ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("apache-1.1", "apache", f"apache (?:software )?{LICENSE}{VERSION}1 1"),
    ("apache-2.0", "apache", f"apache(?: software)?(?: {LICENSE})?{VERSION}2(?: 0)?"),
    ("apache", "apache", f"apache (?:software )?{LICENSE}"),
    ("gpl-1.0", " gpl", f"(?:gnu )?gpl{VERSION}1(?: 0)?"),
    ("gpl-2.0", " gpl", f"(?:gnu )?gpl{VERSION}2(?: 0)?"),
    ("gpl-3.0", " gpl", f"(?:gnu )?gpl{VERSION}3(?: 0)?"),
    ("gpl-1.0", "general public", f"(?:gnu )?general {LICENSE}{VERSION}1(?: 0)?"),
    ("gpl-2.0", "general public", f"(?:gnu )?general {LICENSE}{VERSION}2(?: 0)?"),
    ("gpl-3.0", "general public", f"(?:gnu )?general {LICENSE}{VERSION}3(?: 0)?"),
    ("gpl", "general public", f"(?:gnu )?general {LICENSE}"),
    ("lgpl-2.0", "library general", f"(?:gnu )?library general {LICENSE}{VERSION}2(?: 0)?"),
    ("lgpl-2.1", "lesser general", f"(?:gnu )?lesser general {LICENSE}{VERSION}2 1"),
    ("lgpl-3.0", "lesser general", f"(?:gnu )?lesser general {LICENSE}{VERSION}3(?: 0)?"),
    ("lgpl-2.1", "lgpl", f"(?:gnu )?lgpl{VERSION}2 1"),
    ("lgpl-3.0", "lgpl", f"(?:gnu )?lgpl{VERSION}3(?: 0)?"),
    ("lgpl", "lesser general", f"(?:gnu )?lesser general {LICENSE}"),
    ("agpl-3.0", "affero", f"(?:gnu )?affero general {LICENSE}(?:{VERSION}3(?: 0)?)?"),
    ("agpl-3.0", "agpl", f"(?:gnu )?agpl{VERSION}3(?: 0)?"),
    ("gfdl", "free documentation", f"(?:gnu )?free documentation {LICENSE}"),
    ("bsd-2-clause", "bsd", f"(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd|two clause bsd)(?: {LICENSE})?"),
    ("bsd-3-clause", "bsd", f"(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd)(?: {LICENSE})?"),
    ("bsd-4-clause", "bsd", f"(?:original bsd|bsd 4 clause|4 clause bsd|four clause bsd)(?: {LICENSE})?"),
    ("bsd", "bsd", f"bsd(?: style)? {LICENSE}"),
    ("bsd", "redistribution and use", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("isc", " isc ", f"isc {LICENSE}"),
    ("zlib", "zlib", f"zlib(?: libpng)? {LICENSE}"),
    ("libpng", "libpng", f"libpng {LICENSE}"),
    ("boost-1.0", "boost", f"boost software {LICENSE}(?:{VERSION}1(?: 0)?)?"),
    ("mpl-1.1", "mozilla", f"mozilla {LICENSE}{VERSION}1 1"),
    ("mpl-2.0", "mozilla", f"mozilla {LICENSE}{VERSION}2(?: 0)?"),
    ("mpl-2.0", " mpl", f"mpl{VERSION}2(?: 0)?"),
    ("epl-1.0", "eclipse", f"eclipse {LICENSE}{VERSION}1(?: 0)?"),
    ("epl-2.0", "eclipse", f"eclipse {LICENSE}{VERSION}2(?: 0)?"),
    ("edl-1.0", "eclipse", f"eclipse distribution {LICENSE}(?:{VERSION}1(?: 0)?)?"),
    ("cddl-1.0", "common development", f"common development and distribution {LICENSE}(?:{VERSION}1(?: 0)?)?"),
    ("cpl-1.0", "common public", f"common {LICENSE}(?:{VERSION}1(?: 0)?)?"),
    ("eupl-1.2", "european union", f"european union {LICENSE}(?:{VERSION}1 2)?"),
    ("artistic-2.0", "artistic", f"artistic {LICENSE}(?:{VERSION}2(?: 0)?)?"),
    ("ofl-1.1", "open font", f"(?:sil )?open font {LICENSE}(?:{VERSION}1 1)?"),
    ("psf-2.0", "python software", f"python software foundation {LICENSE}"),
    ("php-3.01", " php ", f"php {LICENSE}(?:{VERSION}3(?: 01)?)?"),
    ("postgresql", "postgresql", f"postgresql {LICENSE}"),
    ("ms-pl", "microsoft", f"microsoft {LICENSE}"),
    ("unlicense", "unlicense", "(?:the )?unlicense"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("public-domain", "public domain", "(?:dedicated to|released into|placed in|is in) the public domain"),
    ("cc0-1.0", "cc0", "cc0(?: 1 0)?"),
    ("cc-by-nc-nd", " cc by", "cc by nc nd(?: [1-4] [0-9])?"),
    ("cc-by-nc-sa", " cc by", "cc by nc sa(?: [1-4] [0-9])?"),
    ("cc-by-nc", " cc by", "cc by nc(?: [1-4] [0-9])?"),
    ("cc-by-nd", " cc by", "cc by nd(?: [1-4] [0-9])?"),
    ("cc-by-sa", " cc by", "cc by sa(?: [1-4] [0-9])?"),
    ("cc-by", " cc by", "cc by(?: [1-4] [0-9])?"),
    ("cc-by", "creative commons", f"creative commons attribution (?:[1-4] [0-9] )?(?:international |unported )?{LICENSE}"),
    ("cc", "creative commons", f"creative commons {LICENSE}"),
)
# The ways in which texts say that a license holds: words that must
# occur, words before and after the license, priority (0 is best) and how sure a match is.
GIVEN = "(?:licensed|released|distributed|available|published|provided|offered|shared|covered)"
WORK = "(?:work|software|program|code|source code|file|library|package|project|document|dataset|data|material)"
FORMS = (
    (" spdx license identifier ", "spdx license identifier ", "", 0, 0.99),
    (" under ", f"(?:this|the) {WORK} is (?:dual )?{GIVEN} under (?:the )?(?:terms of (?:the )?)?", "", 0, 0.97),
    (" any later version ", "", " or (?:at your option )?any later version", 0, 0.97),
    (" under ", f"{GIVEN} under (?:the )?(?:terms of (?:the )?)?", "", 1, 0.95),
    ("s of ", "(?:terms|conditions|provisions) of (?:the )?", "", 1, 0.9),
    (" see ", "see (?:the )?(?:file )?", "", 2, 0.8),
    (" refer to ", "refer to (?:the )?(?:file )?", "", 2, 0.8),
    (" ", "", "", 3, 0.7),
)


@dataclass(frozen=True)
class Rule:
    label: str
    gate: str
    way: str
    pattern: str
    priority: int
    sure: float


def rules() -> list[Rule]:
    """Every license in every form, in order of priority and then of the tables."""
    return sorted((Rule(label, gate, way, f" {before}{name}{after}(?= )", priority, sure)
                   for label, gate, name in NAMES for way, before, after, priority, sure in FORMS),
                  key=lambda r: r.priority)


def gates_in(spaced: Column, rule_list: list[Rule]) -> Column:
    """Those of the rules' gates that occur in a text's words joined by spaces; without one no rule can match."""
    return F.filter(F.array(*[F.lit(g) for g in sorted({r.gate for r in rule_list})]), lambda g: F.contains(spaced, g))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def detections(spaced: Column, gates: Column, rule_list: list[Rule]) -> Column:
    """Array of (rule, its priority, label and sureness, n, gap, width): the n-th match of a rule, and the text length before it since the last."""
    table_of = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(r.gate).alias("gate"), F.lit(r.way).alias("way"), F.lit(r.pattern).alias("pattern"),
                                  F.lit(r.priority).alias("priority"), F.lit(r.label).alias("label"), F.lit(r.sure).alias("sure"))
                         for n, r in enumerate(rule_list)])

    def matches(r: Column) -> Column:
        return let(F.struct(F.split(spaced, r["pattern"], -1).alias("gaps"),
                            F.regexp_extract_all(spaced, r["pattern"], F.lit(0)).alias("hits")),
                   lambda m: F.transform(m["hits"], lambda hit, n: F.struct(
                       *[r[c].alias(c) for c in ("rule", "priority", "label", "sure")], n.alias("n"), F.length(F.get(m["gaps"], n)).alias("gap"), F.length(hit).alias("width"))))

    return F.flatten(F.transform(F.filter(table_of, lambda r: F.array_contains(gates, r["gate"]) & F.contains(spaced, r["way"])), matches))


def scan(docs: DataFrame, text: str = "text", rule_list: list[Rule] | None = None) -> DataFrame:
    """Per row of ``docs`` its other columns with n_words, the base places and the rules' labels and score."""
    rule_list = rule_list or rules()
    keep = [c for c in docs.columns if c != text]
    kept = F.struct(*[F.col(f"`{c}`") for c in keep])
    worded = docs.select(kept.alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text")).select(
        "row", F.monotonically_increasing_id().alias("row_id"), words_of(F.col("text")).alias("words"))

    def starts(words: Column) -> Column:
        def at(n: Column) -> Column:
            found = F.lit(False)
            for phrase, _ in BASE:
                here = F.lit(True)
                for k, word in enumerate(phrase.split()):
                    here = here & (F.get(words, n + k) == word)
                found = found | F.coalesce(here, F.lit(False))
            return found
        return F.filter(F.transform(words, lambda _, n: n), at)

    spaced = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
    scanned = worded.select(
        "row", "row_id", F.size("words").cast("long").alias("n_words"), F.when(F.array_contains("words", "license"), starts(F.col("words"))).alias("starts"), spaced.alias("spaced"))
    scanned = scanned.select("*", gates_in(F.col("spaced"), rule_list).alias("gates"))
    found = scanned.select(
        "row", "row_id", "n_words", F.coalesce(F.size("starts"), F.lit(0)).cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"), F.array_max("starts").cast("long").alias("last_word"),
        F.array_compact(F.array(*[F.when(F.contains("spaced", F.lit(f" {p} ")), F.lit(label)) for p, label in BASE])).alias("base"),
        F.explode_outer(F.when(F.size("gates") > 0, detections(F.col("spaced"), F.col("gates"), rule_list))).alias("hit"))
    placed = found.repartition("row_id").withColumn("end", F.sum(F.col("hit.gap") + F.col("hit.width")).over(
        Window.partitionBy("row_id", "hit.rule").orderBy("hit.n"))).withColumn("start", F.col("end") - F.col("hit.width"))
    earlier = Window.partitionBy("row_id").orderBy("start", F.desc("end"), "hit.rule").rowsBetween(Window.unboundedPreceding, -1)
    levels = sorted({r.priority for r in rule_list})
    covered = F.lit(False)
    for level in levels:
        reach = F.max(F.when(F.col("hit.priority") <= level, F.col("end"))).over(earlier)
        covered = covered | F.coalesce((F.col("hit.priority") == level) & (reach >= F.col("end")), F.lit(False))
    alive = placed.withColumn("alive", F.col("hit").isNotNull() & ~covered)
    return alive.groupBy("row_id").agg(
        F.first("row").alias("row"), *[F.first(c).alias(c) for c in ("n_words", "n_base", "first_word", "last_word", "base")],
        F.collect_set(F.when(F.col("alive"), F.col("hit.label"))).alias("found"),
        F.coalesce(F.max(F.when(F.col("alive"), F.col("hit.sure"))), F.lit(0.0)).alias("score")).select(
        "row.*", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", "found")), ",").alias("labels"), "score")


def op8_licenses(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
