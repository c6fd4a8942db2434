"""License scans by sentence rules. DataFrame functions only; no shuffle, one pass over the texts.

1. A text is normalised: ASCII upper case lowered, comment markers at line starts dropped, white space
   made one space; then cut into sentences after ``. ; : ! ?`` and a space.
2. A sentence that holds one of the licence words is mapped to the identifiers of all known sentences it contains,
   by their place in it; where two overlap the first of the list counts. A known sentence may carry a version,
   kept in the identifier. An SPDX expression gives an identifier for each of its licences.
3. The identifiers of a document in order form a sequence such as ``<mit-grant><mit-notice><as-is>``.
   Ordered rules replace the sub-sequences they know by a licence, ``[MIT]``, longer rules first; each
   sees what the ones before it left. What no rule explains stays visible as unmatched.

Every row gives one row: null and empty texts give an empty sequence, no licences and zeros. Rows may
repeat, ids may be null, other columns are ignored. A very long text is one value of its row, as it was
when it was read; its cost is linear in its length.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known licence sentences, normalised, as regular expressions; the first group, if any, is
# a version. The texts are those of the public licences.
SENTENCES: tuple[tuple[str, str], ...] = (
    ("spdx", r"spdx-license-identifier: ?([a-z0-9.+-]+)"),
    ("mit-grant", r"permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("mit-notice", r"the above copyright notice and this permission notice shall be included"),
    ("isc-grant", r"permission to use, copy, modify,? and(?:/or)? distribute this software for any purpose"),
    ("bsd-grant", r"redistribution and use in source and binary forms, with or without modification"),
    ("bsd-source", r"redistributions of source code must retain"),
    ("bsd-binary", r"redistributions in binary form must reproduce"),
    ("bsd-endorse", r"may be used to endorse or promote products derived from this software"),
    ("bsd-advert", r"all advertising materials mentioning features or use of this software"),
    ("as-is", r"(?:software|work) is provided (?:by the copyright holders and contributors )?[\x22']?as is[\x22']?"),
    ("liability", r"in no event shall (?:the|any) (?:authors?|copyright|regents)"),
    ("agpl-version", r"gnu affero general public licen[sc]e,? (?:as published by the free software foundation, )?(?:either )?v(?:ersion)? ?([0-9](?:\.[0-9])?)"),
    ("lgpl-version", r"gnu (?:lesser|library) general public licen[sc]e,? (?:as published by the free software foundation, )?(?:either )?v(?:ersion)? ?([0-9](?:\.[0-9])?)"),
    ("gpl-version", r"gnu general public licen[sc]e,? (?:as published by the free software foundation, )?(?:either )?v(?:ersion)? ?([0-9](?:\.[0-9])?)"),
    ("agpl-terms", r"under the terms of the gnu affero general public licen[sc]e"),
    ("lgpl-terms", r"under the terms of the gnu (?:lesser|library) general public licen[sc]e"),
    ("gpl-terms", r"under the terms of the gnu general public licen[sc]e"),
    ("either-version", r"either version ([0-9](?:\.[0-9])?) of the licen[sc]e"),
    ("later-version", r"(?:at your option\)? )?any later version"),
    ("gpl-hope", r"distributed in the hope that it will be useful"),
    ("gpl-copy", r"you should have received a copy of the gnu"),
    ("apache-version", r"apache licen[sc]e,? v(?:ersion)? ?([0-9](?:\.[0-9])?)"),
    ("apache-use", r"you may not use this file except in compliance with the licen[sc]e"),
    ("apache-copy", r"you may obtain a copy of the licen[sc]e at"),
    ("apache-basis", r"distributed on an [\x22']?as is[\x22']? basis"),
    ("apache-limits", r"see the licen[sc]e for the specific language governing permissions"),
    ("mpl-version", r"mozilla public licen[sc]e,? v(?:ersion|\.)? ?([0-9](?:\.[0-9])?)"),
    ("mpl-copy", r"if a copy of the mpl was not distributed with this file"),
    ("epl-version", r"eclipse public licen[sc]e,? v(?:ersion|\.)? ?([0-9](?:\.[0-9])?)"),
    ("cc-by-nc-sa", r"\bcc[ -]by-nc-sa ([0-9]\.[0-9])"),
    ("cc-by-nc-nd", r"\bcc[ -]by-nc-nd ([0-9]\.[0-9])"),
    ("cc-by-nc", r"\bcc[ -]by-nc ([0-9]\.[0-9])"),
    ("cc-by-sa", r"\bcc[ -]by-sa ([0-9]\.[0-9])"),
    ("cc-by-nd", r"\bcc[ -]by-nd ([0-9]\.[0-9])"),
    ("cc-by", r"\bcc[ -]by ([0-9]\.[0-9])"),
    ("cc0", r"\bcc0\b|creative commons zero"),
    ("mit-name", r"(?:under|is) (?:the )?mit licen[sc]e|mit[ -]licen[sc]ed"),
    ("bsd-name", r"(?:under|is) (?:the |a )?bsd licen[sc]e"),
    ("isc-name", r"(?:under|is) (?:the )?isc licen[sc]e"),
    ("unlicense", r"released into the public domain"),
    ("public-domain", r"(?:is|are) in the public domain"),
    ("rights-reserved", r"all rights reserved"),
)

# Ordered rules over the sequence of identifiers. ``$1`` is the version.
_V = r":([0-9.]+)"
RULES: tuple[tuple[str, str], ...] = (
    (r"<spdx:([a-z0-9.+-]+)>", "[SPDX:$1]"),
    (r"<mit-grant><mit-notice>(?:<as-is>)?(?:<liability>)?", "[MIT]"),
    (r"<mit-grant>", "[MIT]"),
    (r"<bsd-grant><bsd-source><bsd-binary><bsd-advert>(?:<bsd-endorse>)?(?:<as-is>)?(?:<liability>)?", "[BSD-4-Clause]"),
    (r"<bsd-grant><bsd-source><bsd-binary><bsd-endorse>(?:<as-is>)?(?:<liability>)?", "[BSD-3-Clause]"),
    (r"<bsd-grant><bsd-source>(?:<bsd-binary>)?(?:<as-is>)?(?:<liability>)?", "[BSD-2-Clause]"),
    (r"<isc-grant>(?:<mit-notice>)?(?:<as-is>)?(?:<liability>)?", "[ISC]"),
    (r"<apache-version" + _V + r">(?:<apache-use>)?(?:<apache-copy>)?(?:<apache-basis>)?(?:<apache-limits>)?", "[Apache-$1]"),
    (r"<agpl-(?:version|terms)(?::[0-9.]+)?><either-version" + _V + r">(?:<later-version>)?(?:<gpl-hope>)?(?:<gpl-copy>)?", "[AGPL-$1-or-later]"),
    (r"<lgpl-(?:version|terms)(?::[0-9.]+)?><either-version" + _V + r">(?:<later-version>)?(?:<gpl-hope>)?(?:<gpl-copy>)?", "[LGPL-$1-or-later]"),
    (r"<gpl-(?:version|terms)(?::[0-9.]+)?><either-version" + _V + r">(?:<later-version>)?(?:<gpl-hope>)?(?:<gpl-copy>)?", "[GPL-$1-or-later]"),
    (r"<agpl-version" + _V + r"><later-version>", "[AGPL-$1-or-later]"),
    (r"<lgpl-version" + _V + r"><later-version>", "[LGPL-$1-or-later]"),
    (r"<gpl-version" + _V + r"><later-version>", "[GPL-$1-or-later]"),
    (r"<agpl-version" + _V + r">(?:<gpl-hope>)?(?:<gpl-copy>)?", "[AGPL-$1]"),
    (r"<lgpl-version" + _V + r">(?:<gpl-hope>)?(?:<gpl-copy>)?", "[LGPL-$1]"),
    (r"<gpl-version" + _V + r">(?:<gpl-hope>)?(?:<gpl-copy>)?", "[GPL-$1]"),
    (r"<agpl-terms>(?:<gpl-hope>)?(?:<gpl-copy>)?", "[AGPL]"),
    (r"<lgpl-terms>(?:<gpl-hope>)?(?:<gpl-copy>)?", "[LGPL]"),
    (r"<gpl-terms>(?:<gpl-hope>)?(?:<gpl-copy>)?", "[GPL]"),
    (r"<mpl-version" + _V + r">(?:<mpl-copy>)?", "[MPL-$1]"),
    (r"<epl-version" + _V + r">", "[EPL-$1]"),
    (r"<cc-by-nc-sa" + _V + r">", "[CC-BY-NC-SA-$1]"),
    (r"<cc-by-nc-nd" + _V + r">", "[CC-BY-NC-ND-$1]"),
    (r"<cc-by-nc" + _V + r">", "[CC-BY-NC-$1]"),
    (r"<cc-by-sa" + _V + r">", "[CC-BY-SA-$1]"),
    (r"<cc-by-nd" + _V + r">", "[CC-BY-ND-$1]"),
    (r"<cc-by" + _V + r">", "[CC-BY-$1]"),
    (r"<cc0>", "[CC0-1.0]"),
    (r"<mit-name>", "[MIT]"),
    (r"<bsd-name>", "[BSD]"),
    (r"<isc-name>", "[ISC]"),
    (r"<unlicense>", "[Unlicense]"),
    (r"<public-domain>", "[Public-Domain]"),
)

# Names and short forms of the public licences, looked for after all known sentences; the first group, if
# any, is a version.
_N = r"([0-9](?:\.[0-9])?)"
NAMES: tuple[tuple[str, str], ...] = (
    ("agpl-later", r"\bagpl ?(?:v(?:ersion)? ?|-)?" + _N + r"(?:\+|-or-later)"),
    ("lgpl-later", r"\blgpl ?(?:v(?:ersion)? ?|-)?" + _N + r"(?:\+|-or-later)"),
    ("gpl-later", r"\bgpl ?(?:v(?:ersion)? ?|-)?" + _N + r"(?:\+|-or-later)"),
    ("agpl-short", r"\bagpl ?(?:v(?:ersion)? ?|-)?" + _N),
    ("lgpl-short", r"\blgpl ?(?:v(?:ersion)? ?|-)?" + _N),
    ("gpl-short", r"\bgpl ?(?:v(?:ersion)? ?|-)?" + _N),
    ("or-later", r"\bor (?:\(at your option\) )?later\b"),
    ("apache-short", r"\bapache[- ](?:licen[sc]e[- ])?([0-9]\.[0-9])"),
    ("bsd-clause", r"\bbsd[- ]([0-4])[- ]clause\b"),
    ("clause-bsd", r"\b([0-4])[- ]clause bsd\b"),
    ("mpl-short", r"\bmpl[- ]?(?:v(?:ersion)? ?)?([0-9]\.[0-9])"),
    ("epl-short", r"\bepl[- ]?(?:v(?:ersion)? ?)?([0-9]\.[0-9])"),
    ("eupl-version", r"european union public licen[sc]e,? (?:\(?eupl\)?,? )?v(?:ersion|\.)? ?([0-9]\.[0-9])"),
    ("eupl-short", r"\beupl[- ,]*(?:v(?:ersion|\.)? ?)?([0-9]\.[0-9])"),
    ("artistic", r"\bartistic licen[sc]e,? (?:v(?:ersion)? ?)?([0-9]\.[0-9])"),
    ("by-nc-sa", r"creative commons attribution[- ]noncommercial[- ]sharealike ([0-9]\.[0-9])"),
    ("by-nc-nd", r"creative commons attribution[- ]noncommercial[- ]noderivatives ([0-9]\.[0-9])"),
    ("by-nc", r"creative commons attribution[- ]noncommercial ([0-9]\.[0-9])"),
    ("by-sa", r"creative commons attribution[- ]sharealike ([0-9]\.[0-9])"),
    ("by-nd", r"creative commons attribution[- ]noderivatives ([0-9]\.[0-9])"),
    ("by", r"creative commons attribution ([0-9]\.[0-9])"),
    ("zlib-grant", r"permission is granted to anyone to use this software for any purpose"),
    ("zlib-name", r"\bzlib(?:/libpng)? licen[sc]e\b"),
    ("boost", r"\bboost software licen[sc]e\b"),
    ("unlicense-name", r"\bunlicense\b"),
    ("wtfpl", r"do what the fuck you want to public licen[sc]e|\bwtfpl\b"),
    ("mit-name", r"\bmit licen[sc]e\b"),
    ("bsd-name", r"\bbsd licen[sc]e\b"),
    ("isc-name", r"\bisc licen[sc]e\b"),
    ("apache-name", r"\bapache licen[sc]e\b"),
)
NAME_RULES = (
    *[(f"<{k}-(?:later" + _V + f">|short" + _V + "><(?:or-later|later-version)>)", f"[{k.upper()}-$1$2-or-later]") for k in ("agpl", "lgpl", "gpl")],
    *[(f"<{k}-version" + _V + "><or-later>", f"[{k.upper()}-$1-or-later]") for k in ("agpl", "lgpl", "gpl")],
    *[(f"<{k}-short" + _V + ">", f"[{k.upper()}-$1]") for k in ("agpl", "lgpl", "gpl", "mpl", "epl", "eupl")],
    (r"<apache-short" + _V + ">", "[Apache-$1]"),
    (r"<(?:bsd-clause|clause-bsd)" + _V + ">", "[BSD-$1-Clause]"),
    (r"<eupl-version" + _V + ">", "[EUPL-$1]"),
    (r"<artistic" + _V + ">", "[Artistic-$1]"),
    *[(f"<{k}" + _V + ">", f"[CC-{k.upper()}-$1]") for k in ("by-nc-sa", "by-nc-nd", "by-nc", "by-sa", "by-nd", "by")],
    (r"<zlib-grant>|<zlib-name>", "[Zlib]"),
    (r"<boost>", "[BSL-1.0]"),
    (r"<unlicense-name>", "[Unlicense]"),
    (r"<wtfpl>", "[WTFPL]"),
    (r"<mit-name>", "[MIT]"),
    (r"<bsd-name>", "[BSD]"),
    (r"<isc-name>", "[ISC]"),
    (r"<apache-name>(?:<apache-use>)?(?:<apache-copy>)?(?:<apache-basis>)?(?:<apache-limits>)?", "[Apache]"),
)
#: What a text says it is not under: such a part of a sentence names no licence.
NEGATED = r"\bnot\b[^a-z0-9]{1,4}(?:[a-z]+ ){0,2}under (?:the )?(?:terms of the )?(?:[a-z0-9.+-]+ ){1,5}licen[sc]e"
#: An operator of an SPDX expression, with what stands before it, as written; ``\\G`` carries on where the last one ended.
OPERATOR = r"((?i:spdx-license-identifier:)[ \t]*|\G(?!\A))([(]*[A-Za-z0-9.+:-]+[)]*)[ \t]+(OR|AND|WITH)[ \t]+(?=[(]*[A-Za-z0-9])"
#: Characters for private use: the bounds of an identifier in a sentence, and a licence that follows in an expression.
OPEN, CLOSE, NEXT = "\ue000", "\ue001", "\ue002"

#: A sentence without any of these words holds no known sentence (tested).
WORDS = (
    r"licen[sc]e|permission|redistribution|endorse|advertising materials|as is|in no event|any later version|"
    r"in the hope that|received a copy|a copy of the mpl|cc[ -]by|cc0|creative commons|public domain|rights reserved|"
    r"\b[al]?gpl|\b[em]pl[ -]?v?[0-9]|\beupl|\bwtfpl|\bapache[ -][0-9]|[0-4][ -]clause"
)
MARKERS = r"(?m)^[ \t]*(?:/\*+|\*+/?|//+|#+|--+|;+|<!--)"
SPACE, STOP = r"[ \t\r\n\x0B\x0C]+", r"([.;:!?]) "
#: A tag and its value are one sentence.
TAG = r"(spdx-license-identifier:) "
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _has_version(pattern: str) -> bool:
    return re.search(r"(?<!\\)\((?!\?)", pattern) is not None


def _identifiers(sentence: Column) -> Column:
    """The identifiers of a sentence in order."""
    first = SENTENCES[0][1]
    sentence = F.regexp_replace(sentence, NEGATED, " ")
    # The mark before a licence keeps it from being read as a name below.
    marked = F.regexp_replace(sentence, first.replace(": ?", ": ?[(]*"), f"{OPEN}spdx:_$1{CLOSE}")
    marked = F.regexp_replace(marked, f"[)]*{NEXT}[(]*([a-z0-9.+-]+)", f"{OPEN}spdx:_$1{CLOSE}")
    for k, (_, pattern) in enumerate((*SENTENCES[1:], *NAMES)):
        versioned = _has_version(pattern)
        marked = F.regexp_replace(marked, pattern, f"{OPEN}{k}_:$1{CLOSE}" if versioned else f"{OPEN}{k}_{CLOSE}")
    found = F.regexp_extract_all(marked, F.lit(f"{OPEN}([^{CLOSE}]*){CLOSE}"), F.lit(1))
    names = F.array(*[F.lit(name) for name, _ in (*SENTENCES[1:], *NAMES)])

    def named(token: Column) -> Column:
        number = F.get(names, F.regexp_extract(token, "^([0-9]+)_", 1).cast("int"))
        known = F.concat(F.lit("<"), number, F.regexp_replace(token, "^[0-9]+_", ""), F.lit(">"))
        return F.when(token.startswith("spdx:_"), F.concat(F.lit("<spdx:"), F.substring(token, 7, 1 << 30), F.lit(">"))).otherwise(known)

    return F.transform(found, named)


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, sequence, licenses, n_sentences, n_unmatched`` for every row of ``docs``.

    ``sequence`` is what the rules made of the identifiers, ``licenses`` the distinct licences in code
    point order joined by a comma, ``n_sentences`` the licence sentences found and ``n_unmatched`` those
    that no rule explains."""
    written = F.translate(F.coalesce("text", F.lit("")), OPEN + CLOSE + NEXT, "   ")
    tagged = F.regexp_replace(written, OPERATOR, f"$1$2{NEXT}$3{NEXT}")
    tagged = F.regexp_replace(F.regexp_replace(tagged, f"{NEXT}WITH{NEXT}", "-with-"), f"{NEXT}(?:OR|AND){NEXT}", NEXT)
    written = F.when(written.rlike("(?i)spdx-license-identifier:"), tagged).otherwise(written)
    lowered = F.translate(written, ASCII_UPPER, ASCII_LOWER)
    spaced = F.regexp_replace(F.regexp_replace(lowered, MARKERS, " "), SPACE, " ")
    spaced = F.regexp_replace(spaced, TAG, "$1")
    sentences = F.split(F.regexp_replace(spaced, STOP, "$1\n"), "\n")
    # Most texts hold no licence word: they stop at the first test.
    likely = F.when(lowered.rlike(WORDS.replace(" ", "[ \\t\\r\\n]+(?:[/*#;-]+[ \\t]*)?")), sentences)
    speaking = F.filter(likely, lambda s: s.rlike(WORDS))
    # Kept as a column of its own so that the fold over the rules does not repeat it.
    rows = docs.select(F.col("doc_id"), F.coalesce(F.flatten(F.transform(speaking, _identifiers)), F.array()).alias("ids"))
    sequence = F.array_join("ids", "")
    for pattern, name in (*RULES, *NAME_RULES):
        sequence = F.regexp_replace(sequence, pattern, name)
    ruled = rows.select("doc_id", F.size("ids").cast("long").alias("n_sentences"), sequence.alias("sequence"))
    named = F.array_sort(F.array_distinct(F.regexp_extract_all("sequence", F.lit(r"\[([^\]]+)\]"), F.lit(1))))
    return ruled.select(
        "doc_id",
        "sequence",
        F.array_join(named, ",").alias("licenses"),
        "n_sentences",
        F.regexp_count("sequence", F.lit("<[^>]*>")).cast("long").alias("n_unmatched"),
    )


#: Operators of an SPDX expression that the SQL follows.
OPERATORS = 8


def scan_sql(table: str = "documents") -> str:
    """The same in DuckDB SQL, from the same patterns. Of an SPDX expression it reads the first ``OPERATORS`` + 1
    licences, since its regular expressions cannot carry on where the last one ended."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    licence = r"[(]*[A-Za-z0-9.+:-]+[)]*"
    joined = rf"((?i:spdx-license-identifier:)[ \t]*(?:{licence}{NEXT}(?:OR|AND|WITH){NEXT})*{licence})[ \t]+(OR|AND|WITH)[ \t]+([(]*[A-Za-z0-9])"
    tagged = f"translate(coalesce(text, ''), '{OPEN}{CLOSE}{NEXT}', '   ')"
    for _ in range(OPERATORS):
        tagged = f"regexp_replace({tagged}, {q(joined)}, {q(chr(92) + '1' + NEXT + chr(92) + '2' + NEXT + chr(92) + '3')}, 'g')"
    tagged = f"regexp_replace(replace({tagged}, '{NEXT}WITH{NEXT}', '-with-'), '{NEXT}(?:OR|AND){NEXT}', '{NEXT}', 'g')"
    mark = lambda inner: q(f"{OPEN}{inner}{CLOSE}")
    spdx = mark("spdx:_" + chr(92) + "1")
    marked = f"regexp_replace(s, {q(NEGATED)}, ' ', 'g')"
    marked = f"regexp_replace({marked}, {q(SENTENCES[0][1].replace(': ?', ': ?[(]*'))}, {spdx}, 'g')"
    marked = f"regexp_replace({marked}, {q(f'[)]*{NEXT}[(]*([a-z0-9.+-]+)')}, {spdx}, 'g')"
    known = (*SENTENCES[1:], *NAMES)
    for k, (_, pattern) in enumerate(known):
        versioned = _has_version(pattern)
        inner = f"{k}_:" + chr(92) + "1" if versioned else f"{k}_"
        marked = f"regexp_replace({marked}, {q(pattern)}, {mark(inner)}, 'g')"
    names = "[" + ", ".join(q(name) for name, _ in known) + "]"
    token = f"""CASE WHEN starts_with(x, 'spdx:_') THEN '<spdx:' || substr(x, 7) || '>'
        ELSE '<' || ({names})[CAST(regexp_extract(x, '^([0-9]+)_', 1) AS INTEGER) + 1] || regexp_replace(x, '^[0-9]+_', '') || '>' END"""
    sequence = "array_to_string(ids, '')"
    for pattern, name in (*RULES, *NAME_RULES):
        sequence = f"regexp_replace({sequence}, {q(pattern)}, {q(name.replace('$1', chr(92) + '1').replace('$2', chr(92) + '2'))}, 'g')"
    tag = f"regexp_replace(t, {q(TAG)}, {q(chr(92) + '1')}, 'g')"
    return f"""
WITH lowered AS (SELECT doc_id, translate({tagged}, '{ASCII_UPPER}', '{ASCII_LOWER}') AS t FROM {table}),
spaced AS (SELECT doc_id, regexp_replace(regexp_replace(t, {q(MARKERS)}, ' ', 'g'), {q(SPACE)}, ' ', 'g') AS t FROM lowered),
cut AS (SELECT doc_id, list_filter(string_split(regexp_replace({tag}, {q(STOP)}, E'\\\\1\\n', 'g'), E'\\n'),
  lambda s: regexp_matches(s, {q(WORDS)})) AS sentences FROM spaced),
marked AS (SELECT doc_id, list_transform(sentences, lambda s: {marked}) AS sentences FROM cut),
found AS (SELECT doc_id, list_transform(flatten(list_transform(sentences, lambda s: regexp_extract_all(s, '{OPEN}([^{CLOSE}]*){CLOSE}', 1))), lambda x: {token}) AS ids FROM marked),
ruled AS (SELECT doc_id, len(ids) AS n_sentences, {sequence} AS sequence FROM found)
SELECT doc_id, sequence, n_sentences,
  array_to_string(list_sort(list_distinct(regexp_extract_all(sequence, '\\[([^\\]]+)\\]', 1))), ',') AS licenses,
  len(regexp_extract_all(sequence, '<[^>]*>')) AS n_unmatched
FROM ruled"""
