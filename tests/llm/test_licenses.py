import re

import duckdb
import pytest
from comparison import difference

from basketry.llm import licenses
from edge_rows import edge, nothing  # noqa: F401

MIT = """// Permission is hereby granted, free of charge, to any
// person obtaining a copy of this software. The above copyright notice and this
// permission notice shall be included in all copies. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT
// WARRANTY. IN NO EVENT SHALL THE AUTHORS be liable."""
BSD3 = """Redistribution and use in source and binary forms, with or without modification, are permitted:
* Redistributions of source code must retain the notice.
* Redistributions in binary form must reproduce the notice.
* Neither name may be used to endorse or promote products derived from this software.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS". In no event shall the copyright owner."""
GPL = """This is free software; you can redistribute it under the terms of the GNU General Public License;
either version 2 of the License, or (at your option) any later version. It is distributed in the hope that it will
be useful. You should have received a copy of the GNU General Public License."""


def scan(spark, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in licenses.scan(docs).collect()}


def test_rules(spark):
    found = scan(
        spark, MIT, BSD3, GPL,
        "x\nLicensed under the Apache License, Version 2.0.\ny", "Licensed under CC BY-NC 4.0. Released under the MIT License.",
        "All rights reserved.", "SPDX-License-Identifier: MPL-2.0", "A licence is nothing here.",
    )
    got = [found[i].licenses for i in range(8)]
    assert got == ["MIT", "BSD-3-Clause", "GPL-2-or-later", "Apache-2.0", "CC-BY-NC-4.0,MIT", "", "SPDX:mpl-2.0", ""]
    assert [found[i].n_unmatched for i in range(8)] == [0, 0, 0, 0, 0, 1, 0, 0]
    assert found[0].sequence == "[MIT]" and found[0].n_sentences == 4


def test_several_licences_in_a_sentence(spark):
    found = scan(
        spark, "Dual licensed under the MIT License or the Apache License, Version 2.0", "SPDX-License-Identifier: MIT OR GPL-2.0-only",
        "# SPDX-License-Identifier: (CC0-1.0 OR MIT) AND GPL-2.0-only WITH Classpath-exception-2.0\nAND so on", "MIT License\n\nCopyright (c) A",
        "GNU General Public License version 2, or any later version, or the BSD license", "SPDX-License-Identifier: MIT and this OR that",
        "Released under the MIT License, all rights reserved",
    )
    assert [found[i].licenses for i in range(7)] == [
        "Apache-2.0,MIT", "SPDX:gpl-2.0-only,SPDX:mit", "SPDX:cc0-1.0,SPDX:gpl-2.0-only-with-classpath-exception-2.0,SPDX:mit", "MIT",
        "BSD,GPL-2-or-later", "SPDX:mit", "MIT",
    ]
    assert found[0].sequence == "[MIT][Apache-2.0]" and [found[i].n_unmatched for i in range(7)] == [0, 0, 0, 0, 0, 0, 1]


NAMED = {
    "Licensed under GPLv3.": "GPL-3",
    "GNU GPL v2 or later": "GPL-2-or-later",
    "released as LGPL-2.1+": "LGPL-2.1-or-later",
    "AGPL-3.0-or-later": "AGPL-3.0-or-later",
    "under the Apache-2.0 license": "Apache-2.0",
    "The BSD-3-Clause license applies": "BSD-3-Clause",
    "a 2-clause BSD licence": "BSD-2-Clause",
    "the zlib license": "Zlib",
    "Boost Software License - Version 1.0": "BSL-1.0",
    "Licensed under the EUPL, Version 1.2": "EUPL-1.2",
    "European Union Public Licence v1.2": "EUPL-1.2",
    "the Artistic License 2.0": "Artistic-2.0",
    "Creative Commons Attribution 4.0 International License": "CC-BY-4.0",
    "Creative Commons Attribution-ShareAlike 4.0 International License": "CC-BY-SA-4.0",
    "MPL 2.0 and EPL-2.0": "EPL-2.0,MPL-2.0",
    "This is the Unlicense.": "Unlicense",
    "This program is not under the MIT license.": "",
    "It is *not* licensed under the terms of the GNU General Public License": "",
    "not under the MIT license but under the Apache License, Version 2.0": "Apache-2.0",
    "SPDX-License-Identifier: MIT OR (GPL-2.0-only WITH Classpath-exception-2.0) AND ISC": "SPDX:gpl-2.0-only-with-classpath-exception-2.0,SPDX:isc,SPDX:mit",
}


def test_names_short_forms_and_negation(spark):
    found = scan(spark, *NAMED)
    assert {t: found[i].licenses for i, t in enumerate(NAMED)} == NAMED


def test_sql_is_the_same_operator(spark):
    """Several sentences, names and expressions in a text, in SQL too."""
    texts = [MIT, BSD3, GPL, *NAMED, "\n".join(NAMED), "Dual licensed under the MIT License or the Apache License, Version 2.0; all rights reserved"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    assert difference(licenses.scan(df), con, licenses.scan_sql()) is None


def test_the_word_test_lets_every_known_sentence_through():
    for name, pattern in licenses.SENTENCES:
        example = pattern.replace("[sc]", "s").replace("[ -]", " ").replace(r"\b", "").replace("(?:under|is) ", "under ")
        assert re.search(licenses.WORDS, re.sub(r"[?()]|\(\?:", "", example)), name


def test_matches_sql(spark, edge, nothing, small):
    con = duckdb.connect()
    for df in (spark.read.parquet(f"{small}/documents.parquet"), edge, nothing):
        con.register("documents", df.select("doc_id", "text").toArrow())
        assert difference(licenses.scan(df), con, licenses.scan_sql()) is None
        con.unregister("documents")


@pytest.mark.parametrize("text", ["", None, "\n\n", "licence " * 10_000])
def test_edges(spark, text):
    assert scan(spark, text)[0].licenses == ""
