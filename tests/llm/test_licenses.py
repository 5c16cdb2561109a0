import random
import re

from tarmac.llm import licenses

TEXTS = [
    "Released under the MIT License.", "x Apache License, Version 2.0 y", "CC BY-NC 4.0", "cc by ncx", "mit license",
    "under the mit license under the mit license", "Relased undr the MIT License", "Licensed under the Apache Lisence, Version 2.0",
    "This is licensed under the GNU General Public License, version 3.", "nothing here", "underthe mit license",
    "Über the MIT  License", "cc by nc", "licensed under cc-by-nc 4.0\nunder\nthe\nmit\nlicense", "",
]


def base(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, labels = [], set()
    for phrase, label in (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")):
        p = phrase.split()
        for i in range(len(words)):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


def test_base_matches_brute_force(documents):
    rows = list(enumerate(TEXTS)) + [(99, None)]
    found = licenses.report(documents(rows), "doc_id").collect()
    for r in found:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(dict(rows)[r.doc_id] or ""), r
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1


def test_edited_notices_are_found_with_their_edits(documents):
    found = {r.doc_id: r for r in licenses.scan(documents(list(enumerate(TEXTS)))).collect()}
    spans = lambda i: [(s.label, s.first, s.last, s.edits) for s in found[i].spans if not s.exact]
    assert spans(6) == [("mit", 0, 4, 2)]
    assert ("apache-2", 0, 6, 2) in spans(7) or any(s[0] == "apache-2" for s in spans(7))
    assert any(s[0] == "gpl-3" and s[3] == 0 for s in spans(8))
    assert not found[9].spans


def test_any_edits_up_to_the_bound_leave_a_seed():
    notice, k = "released under the mit license", 2
    pieces = licenses.seeds(notice, k)
    assert len(pieces) == k + 1 and "".join(p for p, _ in pieces) == notice


def test_odd_rows(documents, odd):
    rows = licenses.report(documents(odd), "doc_id").collect()
    assert len(rows) == len(odd) and all(r.labels == "" and r.n_base == 0 for r in rows)
    assert licenses.report(documents([]).limit(0), "doc_id").count() == 0


def test_other_licenses_and_neighbours(documents):
    texts = ["licensed under cc by sa 4 0", "licensed under cc by nd 4 0", "licensed under the gnu general public license version 2",
             "mozilla public license version 1 1", "lisensed under cc by nc 4 0", "mozila public license version 2 0",
             "released undr the mit licence released under the mit license",
             "漢字 released undér thé mit license 漢字", "relea漢ed under 漢the mit license"]
    found = {r.doc_id: r for r in licenses.scan(documents(list(enumerate(texts)))).collect()}
    spans = {i: [(s.label, s.first, s.last, s.edits) for s in found[i].spans if not s.exact] for i in found}
    assert not any(spans[i] for i in range(4))
    assert spans[4] == [("cc-by-nc", 0, 6, 1)] and spans[5] == [("mpl-2", 0, 5, 1)]
    assert spans[6] == [("mit", 0, 4, 2), ("mit", 5, 9, 0)]
    assert spans[7] == [("mit", 1, 5, 2)] and spans[8] == [("mit", 0, 4, 2)]


def test_no_notice_is_found_in_the_notice_of_another_license(documents):
    others = ["mpl", "ms", "min", "bsd", "isc", "gpl", "epl", "cc0", "zlib", "eupl", "unlicense", "mlt", "mits", "smit"]
    texts = [f"released under the {name} license" for name in others] + [f"licensed under the {name} license version 2 0" for name in others]
    texts += [f"licensed under cc by {kind} 4 0" for kind in ("sa", "nd", "sa nd", "zero")]
    texts += ["gnu affero general public license version 3", "gnu free documentation license", "eclipse public license version 2 0",
              "boost software license version 1 0", "creative commons attribution sharealike", "european union public license 1 2"]
    found = {r.doc_id: r for r in licenses.scan(documents(list(enumerate(texts)))).collect()}
    assert {texts[i]: r.spans for i, r in found.items() if r.spans} == {}


def distance(a, b):
    """Edits from ``a`` to ``b``."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_fuzzy_spans_against_edit_distances(documents):
    """Every planted notice with so many edits that the bound allows is found, and what is found is so near."""
    draw, texts, planted = random.Random(6), [], []
    for notice, label in licenses.NOTICES.items():
        for k in range(licenses.MAX_EDITS[notice] + 1):
            words, telling = notice.split(), licenses.TELLING.get(notice, ())
            for _ in range(k):
                i = draw.choice([i for i, w in enumerate(words) if w not in telling and len(w) > 3])
                p = draw.randrange(1, len(words[i]) - 1)
                words[i] = words[i][:p] + draw.choice(["", "q", words[i][p] + "q"]) + words[i][p + 1:]
            texts.append(f"zz yy {' '.join(words)} xx ww")
            planted.append((label, 2, 1 + len(words), notice))
    found = {r.doc_id: r for r in licenses.scan(documents(list(enumerate(texts)))).collect()}
    for i, (label, first, last, notice) in enumerate(planted):
        spans = [s for s in found[i].spans if not s.exact]
        assert any(s.label == label and s.first == first and s.last == last for s in spans), texts[i]
        for s in spans:
            near = min(distance(n, " ".join(texts[i].split()[s.first:s.last + 1])) for n in licenses.NOTICES if licenses.NOTICES[n] == s.label)
            assert near <= s.edits <= max(licenses.MAX_EDITS.values())
