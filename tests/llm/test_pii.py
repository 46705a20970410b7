import random
import re

from tabulon.llm import pii


def luhn(digits):
    return sum(d if k % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2) for k, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base(text):
    text, out = text or "", []
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 14 <= len(digits(m)) <= 19 and luhn(digits(m)):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(digits(m)) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


ATOMS = [
    "a@b.c_d@e.f", "x@y", "a.b+c@d-e.f.gh", ".@a.b", "1.2.3.4.5.6.7.8", "256.1.1.1", "0000255.1.2.3", "1.2.3", "4111 1111 1111 1111",
    "4111-1111-1111-1112", "5  67", "+1 (743) 555-3824", "+12345", "+1+1 555 555 5555", "+", "-", "12 34 56", "é", "ñ😀", " ", "\n", ".", "@",
    "(743) 555-3824", "name [at] mail [dot] com", "2020-10-12 10:20", "%a_@b.c%d@e.f",
]


def test_base_spans_against_brute_force(spark):
    r = random.Random(3)
    texts = ["".join(r.choice(ATOMS) + r.choice(["", " ", "x"]) for _ in range(r.randint(0, 14))) for _ in range(150)]
    texts += [None, "", "9" * 20000, "a" * 20000, "1.2.3.4 " * 700, "+" * 2000, "1 " * 9000, "a.b" * 6000 + "@x.y"]
    docs = spark.createDataFrame([(k, t, "old") for k, t in enumerate(texts)] * 2, "doc_id long, text string, spans string")
    got = pii.spans(docs).collect()
    assert len(got) == 2 * len(texts)
    for g in got:
        assert [tuple(s) for s in g["base"]] == base(g["text"]), g["text"]
        assert set(g["base"]) <= set(g["spans"])
    assert pii.spans(docs.limit(0)).collect() == []


def test_added_spans_and_redaction(spark):
    texts = [
        "call (743) 555-3824 now", "write name [at] mail [dot] com", "on 2020-10-12 10:20 we met", "it cost 1,234,567 or 12345678",
        "plain words only", None, "4465758382889437 4465758382889437", "ip 1.2.3.4, é +1 (743) 555-3824.", "",
    ]
    docs = spark.createDataFrame([(k, t, 1, 2) for k, t in enumerate(texts)], "doc_id long, text string, base int, spans int")
    got = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert pii.redact(docs).columns == docs.columns
    assert [got[k] for k in (0, 1, 6, 7)] == ["call [PHONE] now", "write [EMAIL]", "[CARD] [CARD]", "ip [IP], é [PHONE]."]
    assert all(got[k] == texts[k] for k in (2, 3, 4, 5, 8))


def test_trees_part_held_out_examples(spark):
    model = pii.train(spark)
    assert set(model) == set(pii.KINDS) and all(limit < 1e8 for _, limit in model.values())


def test_every_number_of_a_list_is_scored(spark):
    texts = {
        "(212) 555-0123, (212) 555-0199": "[PHONE], [PHONE]", "212-555-0123 / 646-555-0199": "[PHONE] / [PHONE]", "2024-01-02 (212) 555-0123": "2024-01-02 [PHONE]",
        "(212) 555-0123, (212) 555-0199, (212) 555-0147, (212) 555-0158": "[PHONE], [PHONE], [PHONE], [PHONE]", "+1 (743) 555-3824, (743) 555-3824": "[PHONE], [PHONE]",
        "2024-01-02 10:20, 2024-01-03 11:30": "2024-01-02 10:20, 2024-01-03 11:30",
    }
    docs = spark.createDataFrame([(k, f"see {t} there") for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert [got[k] for k in range(len(texts))] == [f"see {t} there" for t in texts.values()]


#: Templates that training has not seen.
OTHERS = (
    ("phone", 1, "ring 599-999-9999"), ("phone", 1, "5(999)999-9999"), ("phone", 1, "tel 599 9999999"), ("phone", 1, "phone: (599)999-9999"),
    ("phone", 0, "2099/09/09 09.09"), ("phone", 0, "599.99 999.99"), ("phone", 0, "5,999,999.99"), ("phone", 0, "no 59999999"),
    ("card", 1, "card LLLL-LLLL/LLLL-LLLL"), ("card", 1, "LLLL/LLLL/LLLL/LLLL"), ("card", 0, "599-999-9999, 599-999-9999, 599"), ("card", 0, "5999 9999 9999"),
    ("ip", 1, "ip: 199,99,99,99"), ("ip", 1, "host 599-9-9-99"), ("ip", 0, "5-9-9-9"), ("ip", 0, "59 59 59 59"),
    ("email", 1, "reach {w} [at] {h} (dot) {t}"), ("email", 1, "{w}-{w} (at) {h}.{t}"), ("email", 0, "we {w} @ {h}. {w}"), ("email", 0, "7 @ 99.5"),
)


def test_precision_and_recall_on_other_templates(spark):
    got = pii.judged(spark, OTHERS, pii.train(spark))
    assert all(precision >= 0.7 and recall >= 0.6 for precision, recall in got.values()), got
    assert all(got[k] == (1.0, 1.0) for k in ("ip", "card", "email")), got


def test_long_texts_and_many_spans(spark):
    texts = ["user@example.com 10.0.0.1 (212) 555-0123, " * 4000, "é (212) 555-0123 / 646-555-0199; " * 500 + "end"]
    want = ["[EMAIL] [IP] [PHONE], " * 4000, "é [PHONE] / [PHONE]; " * 500 + "end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r["text"] for r in pii.redact(docs).orderBy("doc_id").collect()] == want
