import hashlib
import re

from strata.llm import privacy


def luhn(text):
    d = [int(c) for c in text if c.isdigit()][::-1]
    return sum(c if i % 2 == 0 else (2 * c if c < 5 else 2 * c - 9) for i, c in enumerate(d)) % 10 == 0


def brute(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 14 <= sum(c.isdigit() for c in m.group()) <= 19 and luhn(m.group()):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


TRICKY = [
    "mail a.b+c@x-y.example.com, a@b.c_d@e.f.g a@b a@b. @x.y 😀 é@é.com joe@ex.co.uk.",
    "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 01.002.0255.3 1.2.3 999999999999999999999.1.1.1 0000000000000000255.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1111 41111111111111112 378282246310005 4111  1111 1111 1111 12 34",
    "+1 (555) 123-4567 +1 555 +44 20 7946 0958 +12345678901234567 +1.555.123.4567+1 222 333 4444 + 1 222 333 4444",
    "card 4111111111111111 and +4111111111111111 10.0.0.1", "9" * 5000 + " " + "1.2." * 2000 + "3",
    "a" * 4000 + "@" + "b." * 3000 + "c", "+1 (222) 333-4444 " * 700, "4111111111111111 " * 300]


def test_base_spans(spark, odd_docs, odd_rows):
    rows = [(i, t) for i, t in enumerate(TRICKY)]
    got = {r.doc_id: r for r in privacy.scan(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    for i, t in rows:
        want = brute(t)
        text = ",".join(f"{privacy.KINDS[k]}:{s}:{e}" for s, k, e in want)
        assert got[i].base_sha256 == hashlib.sha256(text.encode()).hexdigest(), (i, text[:300], got[i].spans[:300])
        counts = (got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone)
        assert counts == tuple(sum(k == x for _, k, _ in want) for x in range(4))
        assert set(text.split(",")) - {""} <= set(got[i].spans.split(","))
    assert privacy.scan(odd_docs).count() == len(odd_rows)


def test_nothing_to_learn_from(no_docs):
    assert privacy.scan(no_docs).count() == 0


def test_reliabilities_separate_good_and_bad_labelers():
    # the first two labelers agree with the truth, the third votes at random
    patterns = {(0, (1, 1, 1)): 200, (0, (1, 1, -1)): 200, (0, (-1, -1, 1)): 100, (0, (-1, -1, -1)): 100, (0, (1, -1, 0)): 5}
    belief, tables = privacy.reliabilities(patterns)
    assert belief[0, (1, 1, -1)] > 0.95 and belief[0, (-1, -1, 1)] < 0.05
    v = tables[0]["votes"]
    assert v[1, 0, 1] > 0.9 and abs(v[1, 2, 1] - v[0, 2, 1]) < 0.1
    assert privacy.train_classifier([]) == {}


def test_classifier_adds_obfuscated_spans(spark):
    rows = [(i, f"please mail joe{i}@mail{i % 7}.example.com or call +1 (555) 123-{4000 + i} today") for i in range(200)]
    rows += [(1000 + i, f"contact anna{i} (at) mail.example.com soon, phone (555) 321-{5000 + i}") for i in range(20)]
    rows += [(2000 + i, f"part 0000-{i:04d}-1234-99 of plan 123.456.789.{i}") for i in range(40)]
    got = {r.doc_id: r.spans for r in privacy.scan(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert sum(got[1000 + i].startswith("email:8:") for i in range(20)) >= 18
    for i, text in rows[-40:]:
        base = {f"{privacy.KINDS[k]}:{s}:{e}" for s, k, e in brute(text)}
        assert set(got[i].split(",")) - {""} <= base


def test_redaction(spark, odd_docs):
    rows = [(1, "to a@b.cd, ip 1.2.3.4!", 22, "k"), (1, "to a@b.cd, ip 1.2.3.4!", 22, "k"), (2, None, None, "k"),
            (3, "nothing", 99, None), (4, "+1 222 333 4444", 15, "k")]
    df = spark.createDataFrame(rows, "doc_id int, text string, n_chars int, key string")
    got = privacy.redact(df)
    assert got.columns == df.columns and got.schema["n_chars"].dataType == df.schema["n_chars"].dataType
    out = sorted(((r.doc_id, r.text, r.n_chars) for r in got.collect()), key=repr)
    assert out == [(1, "to <EMAIL>, ip <IP>!", 20)] * 2 + [(2, None, None), (3, "nothing", 99), (4, "<PHONE>", 7)]
    assert privacy.redact(odd_docs).count() == odd_docs.count()


def test_runs_no_python(spark):
    plan = privacy.scan(spark.createDataFrame([(1, "x 1.2.3.4")], "doc_id int, text string"))
    assert "Python" not in plan._jdf.queryExecution().toString()


def test_bracketed_numbers_are_found_and_others_are_not(spark):
    """Planted spans that no base pattern has: precision and recall."""
    import random
    rng = random.Random(12)
    def number(area, exchange):
        return f"({area}) {exchange}-{rng.randrange(1000, 9999)}"
    rows, want = [], set()
    for i in range(200):
        real = i % 2 == 0
        n = number(rng.randrange(200, 999), rng.randrange(200, 999)) if real else number(f"0{rng.randrange(10, 99)}", f"1{rng.randrange(10, 99)}")
        lead = rng.choice(["call ", "phone: ", "tel ", "reach us at "]) if real else rng.choice(["item", "part no", "code x"])
        rows.append((i, f"Please {lead}{n} today."))
        if real:
            want.add(i)
    rows += [(1000 + i, f"call +1 415 555 {1000 + i} now") for i in range(40)]
    got = {r.doc_id for r in privacy.find(spark.createDataFrame(rows, "doc_id long, text string")).where("size(added) > 0").collect()}
    assert len(got & want) >= 0.95 * len(want) and len(got - want) <= 0.05 * len(want)
