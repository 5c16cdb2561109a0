from collections import Counter

from pyspark.sql import functions as F

from tarmac.llm.lines import dedup_lines


def expected(rows):
    """Windows in the order of document and line; a later place of a seen window is covered."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        if text is None:
            out[doc_id] = (0, 0, None)
            continue
        lines, covered = text.split("\n"), set()
        for i in range(max(1, len(lines) - 2)):
            window = tuple(lines[i:i + 3])
            if not "".join(window).strip(" "):
                continue
            if window in seen:
                covered |= set(range(i, min(i + 3, len(lines))))
            seen.add(window)
        left = [line for i, line in enumerate(lines) if i not in covered]
        out[doc_id] = (len(lines), len(covered), "\n".join(left) if covered else text)
    return out


def test_matches_brute_force(documents, prose):
    passage = prose(500, 45)
    rows = [(i, prose(i, 40) + ("\n" + passage if i % 2 else "") + "\n" + prose(i + 50, 18)) for i in range(20)]
    rows += [(30, prose(3, 40)), (31, passage), (32, "\n".join(passage.split("\n")[1:4])), (33, "one line"),
             (34, "one line"), (35, "a\nb"), (36, "a\nb"), (37, "a\nb\nc"), (38, "\n\n\n\n"), (39, "\n\n\n\n"),
             (40, "x\ny\nz\nx\ny\nz\nx\ny\nz"), (41, None), (42, ""), (43, "")]
    found = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in dedup_lines(documents(rows)).collect()}
    assert found == expected(rows)


def test_odd_rows_and_clashing_columns(documents, odd):
    docs = documents(odd).withColumn("starts", F.lit("mine")).withColumn("_document", F.lit(2))
    rows = dedup_lines(docs).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in odd)
    assert {r.starts for r in rows} == {"mine"} and {r._document for r in rows} == {2}
    assert [r.text for r in rows if r.doc_id == 5] == ["same row"] * 2  # equal rows are one document
    assert [r.text for r in rows if r.doc_id is None] == ["no key at all"]
    assert dedup_lines(documents([]).limit(0)).count() == 0


def test_a_text_without_repeats_is_left_alone(documents):
    text = "a\r\nb  \n\n\tc\n"
    assert dedup_lines(documents([(1, text)])).first().text == text
