import random
import re

import pyarrow as pa
import pytest

from qaspark.llm import licenses


def words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(w, size=5):
    return [tuple(w[n : n + size]) for n in range(len(w) - size + 1)]


def brute(text, templates, contained=0.8):
    """Every window of every template, by exact containment."""
    own, out = words(text), []
    known = set().union(*(shingles(words(t)) for t in templates.values()))
    for name, template in templates.items():
        wanted, length = set(shingles(words(template))), len(words(template))
        step, spans = max(1, length // 8), []
        for n in range(max(0, -(-(len(own) - length) // step)) + 1):
            at = n * step
            around = own[max(at - step, 0) : at + length + step]
            if not set(shingles(own[at : at + length])) & known:
                continue
            share = len(wanted & set(shingles(around))) / len(wanted)
            if share >= contained:
                last = min(at + length, len(own)) - 1
                if spans and at <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], max(spans[-1][1], last), max(spans[-1][2], share))
                else:
                    spans.append((at, last, share))
        out += [(name, *s) for s in spans]
    return sorted(out)


def test_against_all_windows():
    rng = random.Random(1)
    say = lambda n: " ".join(rng.choice(["the", "license", "of", "Ä", "software", "use"]) for _ in range(n))
    texts = [None, "", "MIT License", "licensed under the", say(300)]
    for template in licenses.TEMPLATES.values():
        for edits in (0, 1, 2):
            parts = template.upper().split()
            for _ in range(edits if len(parts) > 30 else 0):
                parts[rng.randrange(len(parts))] = "zzz"
            texts.append(f"{say(rng.randrange(40))}\n{' '.join(parts)} {say(rng.randrange(40))}")
    texts.append(" ".join([licenses.TEMPLATES["MIT line"]] * 50))
    index = licenses.Templates(licenses.TEMPLATES, 5, 0.8)
    found = index.scan(pa.array(texts))
    for text, matches in zip(texts, found):
        assert sorted(tuple(m.values()) for m in matches) == brute(text, licenses.TEMPLATES)
    assert sum(map(bool, found)) > 30


def test_query_rows(spark):
    folder = "/root/testdata/sf0.001"
    rows = licenses.op4_license_scan(spark, folder).collect()
    expected = set()
    for doc in spark.read.parquet(f"{folder}/documents.parquet").collect():
        expected |= {(doc.doc_id, *m) for m in brute(doc.text, licenses.TEMPLATES)}
    assert set(map(tuple, rows)) == expected and len(rows) == len(expected)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, "Released under the MIT license", 1)] * 2 + [(2, None, 1)], "doc_id long, text string, row int")
    rows = licenses.scan(docs).collect()
    assert [(r.row.row, r.license, r["first"], r["last"], r.containment) for r in rows] == [(1, "MIT line", 0, 4, 1.0)] * 2
    assert licenses.scan(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        licenses.Templates({"x": "too short"}, 5, 0.8)


def found(*texts):
    index = licenses.Templates(licenses.TEMPLATES | licenses.TEXTS, 5, 0.8, licenses.MARKS)
    return [{m["license"] for m in matches} for matches in index.scan(pa.array(texts))]


def test_whole_texts_and_notices_are_found():
    every = licenses.TEMPLATES | licenses.TEXTS
    for name, matches in zip(every, found(*every.values())):
        assert name in matches, name
    assert found("Licensed under the MIT License") == [{"MIT line (licensed)"}]


def test_versions_are_told_apart():
    line = "This work is licensed under the GNU General Public License, version {}."
    assert found(line.format(2), line.format(3)) == [{"GPL-2.0 line"}, {"GPL-3.0 line"}]
    names = ["GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0"]
    assert found(*(licenses.TEMPLATES[name] for name in names)) == [{name} for name in names]
    bare, three = licenses.TEMPLATES["BSD-2-Clause whole"], licenses.TEMPLATES["BSD-3-Clause whole"]
    assert "BSD-3-Clause whole" not in found(bare)[0] and "BSD-3-Clause whole" in found(three)[0]
    texts = ["GPL-2.0 text", "GPL-3.0 text", "LGPL-2.1 text", "LGPL-3.0 text"]
    for name, matches in zip(texts, found(*(licenses.TEXTS[name] for name in texts))):
        assert {m for m in matches if m.endswith(" text")} == {name}
