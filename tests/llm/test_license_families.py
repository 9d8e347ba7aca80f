from lossmill.llm.licenses import TEMPLATES, license_matches

FILLER = "one two three four five six seven eight nine ten " * 3


def test_license_families(table):
    own = {
        "GPL-2.0": {"GPL-2.0"},
        "GPL-3.0": {"GPL-3.0"},
        "GPL-2.0-header": {"GPL-2.0-header", "GPL-header"},
        "GPL-3.0-header": {"GPL-3.0-header", "GPL-header"},
        "LGPL-2.1-header": {"LGPL-2.1-header"},
        "LGPL-3.0-header": {"LGPL-3.0-header"},
        "AGPL-3.0-header": {"AGPL-3.0-header"},
        "BSD-2-Clause": {"BSD-2-Clause", "BSD"},
        "BSD-3-Clause": {"BSD-3-Clause", "BSD"},
        "CC-BY-4.0": {"CC-BY-4.0"},
        "CC-BY-SA-4.0": {"CC-BY-SA-4.0"},
        "EPL-1.0": {"EPL-1.0"},
        "EPL-2.0": {"EPL-2.0"},
        "ISC": {"ISC"},
        "MIT-text": {"MIT-text", "MIT-permission"},
        "MPL-2.0": {"MPL-2.0"},
        "Unlicense": {"Unlicense"},
    }
    docs = {i: FILLER + TEMPLATES[name] + " " + FILLER for i, name in enumerate(own)}
    docs[90] = FILLER + TEMPLATES["BSD-2-Clause"] + " " + FILLER * 20 + TEMPLATES["BSD-3-Clause"]
    found = {}
    for r in license_matches(table(docs.items())).collect():
        found.setdefault(r.doc_id, set()).add(r.license)
    assert found.pop(90) == {"BSD-2-Clause", "BSD-3-Clause", "BSD"}
    assert {name: found.get(i) for i, name in enumerate(own)} == own
