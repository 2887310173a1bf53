"""Perspectives of odd conversations against a plain rendering."""

from hitlake.llm import perspectives

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain(turns, speaker):
    """One part's text and own spans, turn by turn."""
    shown, spans, at = [], [], 0
    for _, role, text in sorted(turns):
        head = "<|im_start|>assistant\n" if role == speaker else f"<|im_start|>user name={role}\n"
        body = f"{text}<|im_end|>"
        if role == speaker:
            spans.append((at + len(head), at + len(head) + len(body)))
        shown.append(head + body)
        at += len(head) + len(body) + 1
    return "\n".join(shown), spans


def check(spark, rows, extra=("*",)):
    found = perspectives.rotate(spark.createDataFrame(rows, SCHEMA).selectExpr(*extra)).collect()
    expected = {}
    for conv in {r[0] for r in rows}:
        mine = [r[1:] for r in rows if r[0] == conv]
        for speaker in {r[1] for r in mine}:
            for part in {r[0] // 128 for r in mine}:
                expected[conv, speaker, part] = plain([r for r in mine if r[0] // 128 == part], speaker)
    assert {(r.conv_id, r.speaker, r.part): (r.text, [(m.start, m.end) for m in r.mask]) for r in found} == expected
    assert len(found) == len(expected)


def test_repeated_rows_ties_and_clashing_columns(spark):
    rows = [(1, 1, "ann", "hi"), (1, 1, "ann", "hi"), (1, 1, "bob", "hi"), (1, 2, "bob", ""), (2, 0, "", "x"), (2, 130, "ann", "\U0001f600 é")]
    check(spark, rows)
    check(spark, rows, ("*", "1 AS speaker", "2 AS part", "3 AS turns", "4 AS mask", "5 AS n_own"))


def test_very_long_texts_and_conversations(spark):
    check(spark, [(1, 0, "ann", "word " * 200_000), (1, 1, "bob", "short")])
    check(spark, [(1, n, "ann" if n % 3 else "bob", f"turn {n}") for n in range(300)])


def test_no_rows(spark):
    assert perspectives.rotate(spark.createDataFrame([], SCHEMA)).collect() == []
    assert perspectives.rotate(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).collect() == []
