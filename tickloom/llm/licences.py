"""Licence recognition by sentence rules.

A text is cut into sentences and each is normalised: lower case, everything but letters a to z
and digits as one space, so line breaks, comment signs and quotes do not matter. A sentence
gives the identifiers of all known phrases it holds, in order of position; of phrases that
overlap, the one earlier in the table counts. The sequence of a text's identifiers is then
matched against ordered rules, longest first; what a rule matches is taken out of the sequence,
so that the parts of a licence are not reported again.

Only column functions are used. Work is in the row: no shuffle, nothing grows but with the text.

* A null or empty text has no licence: an empty string and counts of 0.
* Several licences are reported in the order of their rules' first appearance, each once.
* Known phrases are counted one by one. Sentences that speak of a licence without a known
  phrase are counted as unknown, and identifiers that no rule takes as loose.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Identifier and phrase of known licence sentences, normalised. Earlier phrases
# win over those they overlap.
SENTENCES = (
    ("agpl3", "gnu affero general public license version 3"),
    ("agpl", "gnu affero general public license"),
    ("lgpl3", "gnu lesser general public license version 3"),
    ("lgpl21", "gnu lesser general public license version 2 1"),
    ("lgpl", "gnu lesser general public license"),
    ("gpl3", "gnu general public license version 3"),
    ("gpl2", "gnu general public license version 2"),
    ("gplAs", "terms of the gnu general public license as published by the free software foundation"),
    ("gplCopy", "you should have received a copy of the gnu general public license"),
    ("gplHope", "distributed in the hope that it will be useful but without any warranty"),
    ("gplOr3", "either version 3 of the license or at your option any later version"),
    ("gplOr2", "either version 2 of the license or at your option any later version"),
    ("gpl", "gnu general public license"),
    ("apache2", "licensed under the apache license version 2 0"),
    ("apacheUse", "you may not use this file except in compliance with the license"),
    ("apacheCopy", "you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("apacheAsIs", "software distributed under the license is distributed on an as is basis"),
    ("apacheLimits", "specific language governing permissions and limitations under the license"),
    ("apacheName", "apache license version 2 0"),
    ("mitGrant", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mitNotice", "the above copyright notice and this permission notice shall be included in all copies"),
    ("mitAsIs", "the software is provided as is without warranty of any kind"),
    ("mitLiable", "in no event shall the authors or copyright holders be liable"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "under the terms of the mit license"),
    ("mit", "the mit license"),
    ("iscGrant", "permission to use copy modify and or distribute this software for any purpose"),
    ("iscAsIs", "the software is provided as is and the author disclaims all warranties"),
    ("bsdGrant", "redistribution and use in source and binary forms with or without modification"),
    ("bsdSource", "redistributions of source code must retain the above copyright notice"),
    ("bsdBinary", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsdName", "may be used to endorse or promote products derived from this software without"),
    ("bsdAsIs", "this software is provided by the copyright holders and contributors as is"),
    ("bsd3", "bsd 3 clause license"),
    ("bsd2", "bsd 2 clause license"),
    ("mpl2", "mozilla public license v 2 0"),
    ("mpl2", "mozilla public license version 2 0"),
    ("epl2", "eclipse public license v 2 0"),
    ("epl2", "eclipse public license 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc0", "cc0 1 0 universal"),
    ("cc0", "creative commons zero"),
    ("ccByNcSa4", "licensed under cc by nc sa 4 0"),
    ("ccByNcNd4", "licensed under cc by nc nd 4 0"),
    ("ccByNc4", "licensed under cc by nc 4 0"),
    ("ccBySa4", "licensed under cc by sa 4 0"),
    ("ccByNd4", "licensed under cc by nd 4 0"),
    ("ccBy4", "licensed under cc by 4 0"),
    ("ccByNcSa4", "creative commons attribution noncommercial sharealike 4 0"),
    ("ccByNc4", "creative commons attribution noncommercial 4 0"),
    ("ccBySa4", "creative commons attribution sharealike 4 0"),
    ("ccBy4", "creative commons attribution 4 0"),
)

# Licence and its sequence of identifiers; "?" after one: it may be missing.
RULES = (
    ("Apache-2.0", "apache2 apacheUse apacheCopy? apacheAsIs? apacheLimits?"),
    ("BSD-3-Clause", "bsdGrant bsdSource bsdBinary bsdName bsdAsIs?"),
    ("BSD-2-Clause", "bsdGrant bsdSource bsdBinary bsdAsIs?"),
    ("MIT", "mit? mitGrant mitNotice mitAsIs? mitLiable?"),
    ("ISC", "iscGrant iscAsIs?"),
    ("GPL-3.0-or-later", "gplAs gplOr3 gplHope? gpl? gplCopy?"),
    ("GPL-2.0-or-later", "gplAs gplOr2 gplHope? gpl? gplCopy?"),
    ("AGPL-3.0", "agpl3"),
    ("LGPL-3.0", "lgpl3"),
    ("LGPL-2.1", "lgpl21"),
    ("GPL-3.0", "gpl3"),
    ("GPL-2.0", "gpl2"),
    ("Apache-2.0", "apache2"),
    ("Apache-2.0", "apacheName"),
    ("MIT", "mit"),
    ("BSD-3-Clause", "bsd3"),
    ("BSD-2-Clause", "bsd2"),
    ("MPL-2.0", "mpl2"),
    ("EPL-2.0", "epl2"),
    ("Unlicense", "unlicense"),
    ("CC0-1.0", "cc0"),
    ("CC-BY-NC-SA-4.0", "ccByNcSa4"),
    ("CC-BY-NC-ND-4.0", "ccByNcNd4"),
    ("CC-BY-NC-4.0", "ccByNc4"),
    ("CC-BY-SA-4.0", "ccBySa4"),
    ("CC-BY-ND-4.0", "ccByNd4"),
    ("CC-BY-4.0", "ccBy4"),
)

# Every phrase above holds one of these, so other sentences need no further look.
TELLTALE = "licen[cs]e|permission|warrant|redistribut|copyright|public domain|creative commons|cc0|endorse"
# The same on texts as they stand, where other signs may be between two words.
RAW_TELLTALE = "(?i)" + TELLTALE.replace(" ", "[^a-z0-9]+")
SPEAKS = "licen[cs]ed|licen[cs]e"
ENDS = r"([.!?;:])[\x20\x09-\x0D]+|[\x20\x09-\x0D]*\n[\x20\x09-\x0D]*\n[\x20\x09-\x0D]*"


def rule_pattern(sequence: str) -> str:
    """The regular expression of a rule over identifiers that each have a ``;`` at their end."""
    return r"\b" + "".join(
        f"(?:{i[:-1]};)?" if i.endswith("?") else f"{i};" for i in sequence.split()
    )


def _normal(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def _marked(sentence: Column) -> Column:
    """The sentence with each known phrase as its identifier in braces, which no phrase holds."""
    return reduce(
        lambda s, known: F.replace(s, F.lit(known[1]), F.lit(f"{{{known[0]}}}")), SENTENCES, sentence
    )


def _identifiers(marked: Column) -> Column:
    """The known phrases' identifiers, each with ``;`` after it; ``other;`` or an empty string
    for speaking or silent sentences."""
    names = F.array_join(F.regexp_extract_all(marked, F.lit(r"\{(\w+)\}"), F.lit(1)), ";")
    return (
        F.when(F.contains(marked, F.lit("{")), F.concat(names, F.lit(";")))
        .when(marked.rlike(SPEAKS), "other;").otherwise("")
    )


def identifiers(text: Column) -> Column:
    """The identifiers of a text's sentences in order, each with ``;`` after it."""
    # Sentences are cut at marks that texts do not hold; a mark in a text is a space.
    marked = F.regexp_replace(F.translate(text, "\x01", " "), ENDS, "$1\x01")
    sentences = F.filter(F.split(marked, "\x01"), lambda s: s.rlike(RAW_TELLTALE))
    marked = F.transform(sentences, lambda s: _marked(_normal(s)))
    joined = F.array_join(F.transform(marked, _identifiers), "")
    return F.when(text.rlike(RAW_TELLTALE), joined).otherwise("")


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, licences (comma-separated), n_known, n_unknown and n_loose of every row."""
    ids = F.coalesce(identifiers(F.col("text")), F.lit(""))

    def apply(sequence: Column, rule: tuple[str, str]) -> Column:
        return F.regexp_replace(sequence, rule_pattern(rule[1]), f"<{rule[0]}>;")

    rows = docs.select("doc_id", ids.alias("ids")).select(
        "doc_id", "ids", F.when(F.col("ids") != "", reduce(apply, RULES, F.col("ids"))).otherwise("").alias("left")
    )
    listed = F.regexp_extract_all("left", F.lit("<([^>]+)>"), F.lit(1))
    unknown = F.regexp_count("ids", F.lit("other;")).cast("bigint")
    return rows.select(
        "doc_id",
        F.array_join(F.array_distinct(listed), ",").alias("licences"),
        (F.regexp_count("ids", F.lit(";")) - unknown).cast("bigint").alias("n_known"),
        unknown.alias("n_unknown"),
        F.regexp_count("left", F.lit("(?:^|;)(?!other;|<)[A-Za-z0-9]+(?=;)")).cast("bigint").alias("n_loose"),
    )
