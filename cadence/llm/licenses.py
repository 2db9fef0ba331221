"""License scans with ordered signature rules.

Rules are regular expressions over a canonical text (lower-case words joined
by one blank): sentences of license notices, exceptions and copyright lines
written by hand (``NOTICES``), and five forms of every name of ``FAMILIES``:
negation, identifier line, grant with version, name with version, name alone,
in falling priority.  Three gates keep them off most text: a keyword
expression on the whole text, a literal that must occur in the canonical text,
and the rule itself.  A detection inside another of higher priority, or of
equal priority and greater length, is suppressed; among equals the first rule
stands.  Negations ("not licensed under ...") suppress and are not reported.

Only gated documents are canonicalised and joined with the rule table, which
is a constant of a few hundred rows (so broadcasting it is bounded).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import (ascii_lower, col, fresh, let, materialise, running_sums,
                                with_row_id)

# Phrases of the base scan and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Label, names, versions, identifiers' stem ("" for none).
FAMILIES = [
    ("gpl", ["gnu general public license", "gnu gpl", "general public license", "gpl"],
     ["1", "2", "3"], "gpl"),
    ("lgpl", ["gnu lesser general public license", "gnu library general public license",
              "lesser general public license", "gnu lgpl", "lgpl"], ["2", "2 1", "3"], "lgpl"),
    ("agpl", ["gnu affero general public license", "affero general public license", "gnu agpl",
              "agpl"], ["1", "3"], "agpl"),
    ("gfdl", ["gnu free documentation license", "gfdl"], ["1 1", "1 2", "1 3"], "gfdl"),
    ("apache", ["apache license", "apache software license", "apache public license"],
     ["1 0", "1 1", "2 0"], "apache"),
    ("mit", ["mit license", "mit licence", "expat license", "x11 license"], [], "mit"),
    ("bsd", ["bsd license", "bsd licence", "bsd style license", "0bsd license"], [], "bsd"),
    ("bsd-2-clause", ["bsd 2 clause", "2 clause bsd", "simplified bsd license",
                      "freebsd license"], [], "bsd 2 clause"),
    ("bsd-3-clause", ["bsd 3 clause", "3 clause bsd", "new bsd license",
                      "modified bsd license"], [], "bsd 3 clause"),
    ("mpl", ["mozilla public license", "mpl"], ["1 0", "1 1", "2 0"], "mpl"),
    ("epl", ["eclipse public license", "epl license"], ["1 0", "2 0"], "epl"),
    ("cddl", ["common development and distribution license", "cddl"], ["1 0", "1 1"], "cddl"),
    ("eupl", ["european union public licence", "european union public license", "eupl"],
     ["1 0", "1 1", "1 2"], "eupl"),
    ("cc-by", ["cc by", "creative commons attribution", "cc attribution"],
     ["1 0", "2 0", "2 5", "3 0", "4 0"], "cc by"),
    ("cc-by-sa", ["cc by sa", "creative commons attribution sharealike",
                  "creative commons attribution share alike"],
     ["1 0", "2 0", "2 5", "3 0", "4 0"], "cc by sa"),
    ("cc-by-nc", ["cc by nc", "creative commons attribution noncommercial",
                  "creative commons attribution non commercial"],
     ["1 0", "2 0", "2 5", "3 0", "4 0"], "cc by nc"),
    ("cc-by-nd", ["cc by nd", "creative commons attribution noderivatives",
                  "creative commons attribution no derivatives"],
     ["1 0", "2 0", "2 5", "3 0", "4 0"], "cc by nd"),
    ("cc-by-nc-sa", ["cc by nc sa", "creative commons attribution noncommercial sharealike"],
     ["1 0", "2 0", "2 5", "3 0", "4 0"], "cc by nc sa"),
    ("cc-by-nc-nd", ["cc by nc nd", "creative commons attribution noncommercial noderivatives"],
     ["1 0", "2 0", "2 5", "3 0", "4 0"], "cc by nc nd"),
    ("cc0", ["cc0", "creative commons zero"], ["1 0"], "cc0"),
    ("isc", ["isc license", "isc licence"], [], "isc"),
    ("zlib", ["zlib license", "zlib libpng license"], [], "zlib"),
    ("bsl", ["boost software license"], ["1 0"], "bsl"),
    ("artistic", ["artistic license", "clarified artistic license"], ["1 0", "2 0"], "artistic"),
    ("unlicense", ["the unlicense", "unlicense license"], [], "unlicense"),
    ("wtfpl", ["wtfpl", "do what the fuck you want to public license"], ["1", "2"], "wtfpl"),
    ("ofl", ["sil open font license", "open font license"], ["1 0", "1 1"], "ofl"),
    ("ms-pl", ["microsoft public license", "ms pl license"], [], "ms pl"),
    ("ms-rl", ["microsoft reciprocal license"], [], "ms rl"),
    ("psf", ["python software foundation license", "psf license"], ["2"], "psf"),
    ("php", ["php license"], ["3 0", "3 01"], "php"),
    ("ruby", ["ruby license"], [], "ruby"),
    ("postgresql", ["postgresql license", "postgresql licence"], [], "postgresql"),
    ("odbl", ["open database license", "odbl"], ["1 0"], "odbl"),
    ("osl", ["open software license"], ["1 0", "2 0", "3 0"], "osl"),
    ("afl", ["academic free license"], ["1 1", "2 0", "3 0"], "afl"),
    ("public-domain", ["released into the public domain", "public domain dedication"], [], ""),
    ("proprietary", ["all rights reserved"], [], ""),
]
# label, literal, pattern, priority: notice sentences.
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person",
     "permission is hereby granted free of charge to any person obtaining a copy", 85),
    ("bsl", "permission is hereby granted free of charge to any person or organization",
     "permission is hereby granted free of charge to any person or organization obtaining a copy",
     86),
    ("isc", "this software for any purpose with or without fee is hereby granted",
     "permission to use copy modify and(?: or)? distribute this software for any purpose with or"
     " without fee is hereby granted", 85),
    ("bsd", "redistribution and use in source and binary forms",
     "redistribution and use in source and binary forms(?: with or without modification)?"
     "(?: are permitted)?", 85),
    ("bsd-3-clause", "neither the name of", "neither the name of (?:[^ ]++ ){1,12}?nor the names of"
     " (?:its|their|the) contributors", 86),
    ("bsd-4-clause", "all advertising materials mentioning features",
     "all advertising materials mentioning features or use of this software", 86),
    ("zlib", "without any express or implied warranty",
     "this software is provided as is without any express or implied warranty", 85),
    ("apache", "except in compliance with the license",
     "you may not use this (?:file|software|work) except in compliance with the license", 85),
    ("unlicense", "free and unencumbered software released into the public domain",
     "this is free and unencumbered software released into the public domain", 95),
    ("mpl", "subject to the terms of the mozilla public license",
     "this source code form is subject to the terms of the mozilla public license"
     "(?: v(?:ersion)? [0-9](?: [0-9])?)?", 95),
    ("gpl", "under the terms of the gnu general public license",
     "you can redistribute it and or modify it under the terms of the gnu general public license",
     95),
    ("lgpl", "under the terms of the gnu lesser general public license",
     "you can redistribute it and or modify it under the terms of the gnu lesser general public"
     " license", 95),
    ("agpl", "under the terms of the gnu affero general public license",
     "you can redistribute it and or modify it under the terms of the gnu affero general public"
     " license", 95),
    ("classpath-exception", "classpath exception", "(?:with )?classpath exception(?: 2 0)?", 88),
    ("classpath-exception", "as a special exception the copyright holders",
     "as a special exception the copyright holders of this library give you permission to link", 88),
    ("gcc-exception", "gcc runtime library exception", "gcc runtime library exception", 88),
    ("llvm-exception", "llvm exception", "(?:with )?llvm exceptions?", 88),
    ("copyright", "copyright", "copyright (?:c )?(?:(?:19|20)[0-9]{2})(?: (?:19|20)[0-9]{2})*", 50),
]
NOTICE_SCORE = 0.95
GRANT = (r"(?:licensed|released|distributed|available|provided|published|offered) under"
         r"(?: the)?(?: terms of)?(?: the)?")
NEGATION = (r"(?:not|never|no longer) (?:licensed|released|distributed|available|provided|published"
            r"|offered|covered) (?:under|by)(?: the)?(?: terms of)?(?: the)?")
FORMS = (("negation", 110, 0.0), ("identifier", 100, 0.99), ("grant", 90, 0.95), ("versioned", 80, 0.9), ("name", 60, 0.7))
BASE_SCORE = 0.7

_NOT_WORD = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
#: Every text in which a base phrase or a rule can match passes this.
GATE = (rf"(?i)licen[sc]e|gpl|lgpl|mpl|cddl|eupl|wtfpl|odbl|gfdl|cc0|spdx|rights[{_NOT_WORD}]+reserved"
        rf"|public[{_NOT_WORD}]+domain|clause[{_NOT_WORD}]+bsd|bsd[{_NOT_WORD}]+[23]"
        rf"|hereby|redistribution|copyright|warranty|advertising|contributors|exception"
        rf"|cc[{_NOT_WORD}]+(?:by|attribution)|creative[{_NOT_WORD}]+commons")


def rules() -> list[tuple[int, str, str, str, int, float]]:
    """``(rule, label, literal, pattern, priority, score)``: a canonical text
    that matches the pattern contains the literal.  Negations have no label."""
    out = [(n, label, literal, f"(?<= ){pattern}(?= )", priority, NOTICE_SCORE)
           for n, (label, literal, pattern, priority) in enumerate(NOTICES)]
    for label, names, versions, stem in FAMILIES:
        any_version = "|".join(sorted(versions, key=len, reverse=True))
        made: list[tuple[str, str, str]] = []
        if stem:
            made.append(("identifier", "identifier " + stem,
                         rf"spdx license identifier {stem}(?: (?:{any_version or '[0-9]+'}))?"
                         r"(?: 0)?(?: only| or later)?"))
        for name in names:
            made.append(("negation", name, rf"{NEGATION} {name}(?: license)?"
                         rf"(?:(?: version| v)? (?:{any_version or '[0-9]+'}))?"))
            made.append(("grant", name, rf"{GRANT} {name}(?: license)?"
                         rf"(?:(?: version| v)? (?:{any_version or '[0-9]+'}))?"))
            for version in versions:
                made.append(("versioned", name, rf"{name}(?: license)?(?: version| v)? {version}"
                             r"(?: 0)?(?: or later)?"))
            made.append(("name", name, name))
        scores = {form: (priority, score) for form, priority, score in FORMS}
        for form, literal, pattern in made:
            priority, score = scores[form]
            shown = "" if form == "negation" else label
            out.append((len(out), shown, literal, f"(?<= ){pattern}(?= )", priority, score))
    return out


def _blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _spans(canon: Column, pattern: Column) -> Column:
    """Word intervals ``array<struct<start,end>>`` of a pattern's matches."""
    def placed(matches: Column, pieces: Column) -> Column:
        before = F.transform(F.slice(pieces, F.lit(1), F.size(matches)), _blanks)
        inside = F.transform(matches, _blanks)
        return F.transform(
            F.arrays_zip(running_sums(F.zip_with(before, inside, lambda p, m: p + m)).alias("at"),
                         before.alias("p"), inside.alias("m")),
            lambda x: F.struct((x["at"] + x["p"] - 1).alias("start"),
                               (x["at"] + x["p"] + x["m"]).alias("end")))

    return let(F.regexp_extract_all(canon, pattern, F.lit(0)), lambda matches: let(
        F.split(canon, pattern, -1), lambda pieces: placed(matches, pieces)))


def _standing(hits: DataFrame) -> DataFrame:
    """``hits`` that no other of their document suppresses: whatever contains
    one and wins over it comes before it by start, falling end, falling
    priority and rule, so the largest end so far of every priority decides."""
    earlier = (Window.partitionBy("rid").orderBy("start", F.desc("end"), F.desc("priority"), "rule")
               .rowsBetween(Window.unboundedPreceding, -1))
    priorities = sorted({r[4] for r in rules()})
    reach = {p: F.max(F.when(F.col("priority") == p, F.col("end"))).over(earlier)
             for p in priorities}
    marked = hits.withColumns({f"reach{p}": c for p, c in reach.items()})
    beaten = reduce(lambda x, y: x | y, (
        (F.lit(p) >= F.col("priority"))
        & F.coalesce(F.col(f"reach{p}") >= F.col("end"), F.lit(False)) for p in priorities))
    return marked.where(~beaten).drop(*(f"reach{p}" for p in priorities))


def _places(words: Column, phrase: str) -> Column:
    parts = phrase.split(" ")

    def here(i: Column) -> Column:
        test = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            test = test & F.coalesce(F.get(words, i + k) == part, F.lit(False))
        return test

    last = F.size(words) - len(parts)
    none = F.array().cast("array<int>")
    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), here)
                  ).otherwise(none)


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs`` (a stored table): ``key, n_words, n_base,
    first_word, last_word, base_labels, labels, score`` and ``detections``
    (surviving ``start, end`` words, ``label, priority, score``).

    Words are lower-cased runs of ASCII letters and digits and non-ASCII
    characters.  NULL is an empty text: no words, no labels, score 0.
    Repeated rows stay; an empty table gives an empty result."""
    spark = docs.sparkSession
    rid, = fresh(docs, "rid")
    numbered = with_row_id(docs, rid).select(col(rid).alias("rid"), col(key).alias("key"),
                                             F.coalesce(col(text), F.lit("")).alias("text"))
    counted = numbered.select("rid", "key", F.regexp_count(
        "text", F.lit(f"[^{_NOT_WORD}]+")).cast("long").alias("n_words"))
    words = F.filter(F.split(ascii_lower(F.col("text")), f"[{_NOT_WORD}]+"), lambda w: w != "")
    gated = materialise(
        numbered.where(F.col("text").rlike(GATE)).select("rid", words.alias("w"))
        .withColumn("canon", F.concat(F.lit(" "), F.array_join("w", " "), F.lit(" ")))
        .select("rid", "canon", *(_places(F.col("w"), p).alias(f"base{i}")
                                  for i, p in enumerate(BASE_PHRASES))))
    places = F.flatten(F.array(*(f"base{i}" for i in range(len(BASE_PHRASES)))))
    base_labels = F.array_sort(F.array_distinct(F.filter(F.array(*(
        F.when(F.size(f"base{i}") > 0, F.lit(label))
        for i, label in enumerate(BASE_PHRASES.values()))), lambda x: x.isNotNull())))
    base = gated.select("rid", F.size(places).cast("long").alias("n_base"),
                        F.array_min(places).cast("long").alias("first_word"),
                        F.array_max(places).cast("long").alias("last_word"),
                        base_labels.alias("base"))
    listed = rules()
    literals = sorted({r[2] for r in listed})
    table = spark.createDataFrame(
        listed, "rule int, label string, literal string, pattern string, priority int, score double")
    near = gated.select("rid", "canon", F.explode(F.filter(
        F.array(*map(F.lit, literals)), lambda k: F.contains(F.col("canon"), k))).alias("literal"))
    hits = (near.join(F.broadcast(table), "literal")
            .select("rid", "rule", "label", "priority", "score",
                    F.explode(_spans(F.col("canon"), F.col("pattern"))).alias("s"))
            .select("rid", "s.start", "s.end", "rule", "label", "priority", "score"))
    found = _standing(hits).where("label <> ''").groupBy("rid").agg(F.array_sort(F.collect_list(
        F.struct("start", "end", "rule", "label", "priority", "score"))).alias("detections"))
    none = F.array().cast("array<string>")
    joined = counted.join(base.join(found, "rid", "left"), "rid", "left")
    labels = F.array_sort(F.array_union(
        F.coalesce("base", none),
        F.coalesce(F.transform("detections", lambda s: s["label"]), none)))
    best = F.coalesce(F.array_max(F.transform("detections", lambda s: s["score"])), F.lit(0.0))
    n_base = F.coalesce("n_base", F.lit(0).cast("long"))
    return joined.select(
        F.col("key").alias(key), "n_words", n_base.alias("n_base"), "first_word", "last_word",
        F.array_join(F.coalesce("base", none), ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.greatest(best, F.when(n_base > 0, BASE_SCORE).otherwise(F.lit(0.0))).alias("score"),
        "detections")
