"""Canonical headers as files carry them; expected names written by hand."""

import duckdb

from tests.llm.rows import collected, documents
from tests.llm.test_licence_rules import by_id, wrapped
from tidemark.llm import licence_rules as rules

S = rules.SENTENCES | rules.MORE_SENTENCES
APACHE = """Copyright 2020 Someone

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
BSD = (S["bsd-redistribution"] + "\n\n1. " + wrapped(S["bsd-source"]) + "\n\n2. "
       + wrapped(S["bsd-binary"]) + "\n\n")
CASES = [
    (1, APACHE, "Apache-2.0"),
    (2, " ".join(APACHE.split("\n\n", 1)[1].split()), "Apache-2.0"),
    (3, "/*\n" + "\n".join(" * " + line for line in APACHE.split("\n")) + "\n */", "Apache-2.0"),
    (4, "\n".join("# " + line for line in APACHE.split("\n")), "Apache-2.0"),
    (5, MPL, "MPL-2.0"),
    (6, BSD + wrapped(S["bsd-as-is"]), "BSD-2-Clause"),
    (7, BSD + "3. " + wrapped(S["bsd-names"]) + "\n\n" + wrapped(S["bsd-as-is"]), "BSD-3-Clause"),
    (8, wrapped(S["lgpl-redistribute-2.1"]) + "\n\n" + wrapped(S["lgpl-warranty"]), "LGPL-2.1-or-later"),
    (9, wrapped(S["lgpl-redistribute-3"]) + "\n\n" + wrapped(S["gpl-warranty"]), "LGPL-3.0-or-later"),
    (10, wrapped(S["agpl-redistribute-3"]) + "\n\n" + wrapped(S["gpl-warranty"]), "AGPL-3.0-or-later"),
    (11, APACHE.split("\n\n", 1)[1].replace("\n\n", "\n"), "Apache-2.0"),
]


def test_headers(spark):
    found = by_id(rules.licences(documents(spark, [case[:2] for case in CASES])))
    assert found == {i: {name} for i, _, name in CASES}


def test_headers_equal_sql(spark):
    rows = documents(spark, [case[:2] for case in CASES])
    frame = rows.toPandas()  # noqa: F841
    con = duckdb.connect()
    con.sql("create view documents as select * from frame")
    assert collected(rules.licences(rows)) == sorted(con.sql(rules.oracle_sql()).fetchall(), key=repr)
