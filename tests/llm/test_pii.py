import hashlib
import re

from pyspark.sql import functions as F

from tarmac.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    "mail a.b+c@x-y.example.com, or a@b.c%d@e.f then g@h.i@j.k", "1.2.3.4.5.6.7.8 and 300.1.1.1 and 010.0.0.255 9.9.9",
    "4111 1111 1111 1111 or 4111-1111-1111-1112 or 4111111111111111", "+1 (487) 555-7209 +12 +1(2)3 call +44 20 7946 0958.",
    "é\U0001f600 +49 (30) 1234567 ü x@y.de 1-2-3-4-5 12  34", "@ a@ @b a@b a@b. a@b.c.", "0" * 200, "1." * 100, "a." * 50 + "@" + "b." * 50,
    "12 34 56 78 90 12 34 56 78 90 12 34", "++1 23 45 67 89 0 +", "", "phone: 555-123-4567 today", "write to jo [at] mail [dot] com",
    " ".join(f"u{i}@h{i}.org" for i in range(700)), "+1" + " (" * 300 + "2", "a@b.c\nd@e.f\t1.1.1.1\r\n",
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {
        "email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in match.split(".")),
        "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
    }[kind]


def base(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if passes(k, m.group())]


def shown(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_base_matches_brute_force(documents):
    rows = [*enumerate(TEXTS), (50, None)]
    for r in pii.report(documents(rows), "doc_id").collect():
        spans = base(dict(rows)[r.doc_id])
        counts = [sum(k == kind for k, _, _ in spans) for kind in PATTERNS]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts, dict(rows)[r.doc_id]
        assert r.base_sha256 == hashlib.sha256(shown(spans).encode()).hexdigest()
        assert set(filter(None, shown(spans).split(","))) <= set(r.spans.split(","))


def test_em_learns_whom_to_believe(spark):
    """Two labelers agree with the truth, one votes by chance: EM has to weigh them so."""
    rows = []
    for truth, n in ((1, 60), (-1, 40)):
        for noise in (-1, 1):
            rows += [(0, truth, truth, 0, noise, 0, n // 2), (0, truth, -truth, 0, noise, 0, 2)]
    patterns = spark.createDataFrame(rows, "kind int, strict int, shape int, gazetteer int, helpful int, surroundings int, n long")
    prior, tables = pii.reliabilities(patterns)
    sure = lambda table: table[1][2] / table[0][2]  # noqa: E731  how much a vote for it says
    assert 0.5 < prior[0] < 0.7
    assert sure(tables[0]) > 5 and 0.8 < sure(tables[3]) < 1.25


def test_added_spans_come_from_looser_patterns(documents):
    rows = [(i, f"phone: +1 (487) 555-72{i:02d} call 212-555-01{i:02d} now, mail x{i}@mail.example.com") for i in range(10, 40)]
    rows += [(100 + i, f"order {i} 4000 1234 5678 90{i} serial#123-456-7890x") for i in range(10, 20)]
    found = pii.find(documents(rows)).collect()
    added = {r.doc_id: [s.text for s in r.added] for r in found}
    assert all(t.startswith("212-555") for i in range(10, 40) for t in added[i])
    assert all(not (b.kind == a.kind and b.start < a.stop and a.start < b.stop)
               for r in found for a in r.added for b in r.base)


def test_odd_rows_and_native_plan(documents, odd):
    docs = documents(odd).withColumn("base", F.lit(1)).withColumn("kind", F.lit(2))
    report = pii.report(docs, "doc_id")
    rows = report.collect()
    assert len(rows) == len(odd) and all(r.spans == "" and r.n_card == 0 for r in rows)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
    assert pii.report(documents([]).limit(0), "doc_id").count() == 0
