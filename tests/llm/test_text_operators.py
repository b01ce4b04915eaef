"""Operators on single texts: brute force, exact round trips, and the awkward rows."""

from __future__ import annotations

import random
import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import bpe, chat, language, licenses, pii, quality, secret_scan
from millrace.llm.queries import CONTROL_CHAT, TOKENIZER
from pyspark.sql import functions as F

PATH = public_tokenizers.path(TOKENIZER)
LONG = "Thon ndre " * 30_000

AWKWARD = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, " \n\t ", "en", None),
    (4, LONG, "en", "a"),
    (5, "same text here, twice", "en", "a"),
    (5, "same text here, twice", "en", "a"),
    (None, "no key", "de", "b"),
    (7, "1234 5678 !!", "xx", "b"),
]


def frame(spark, rows=AWKWARD):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


# --- secrets and personal data


def found(pattern, text):
    return list(re.finditer(pattern, text))


def plain_secrets(text):
    name = "|".join(
        "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
        for word in ("password", "passwd", "secret", "token")
    )
    name += "|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
    assign = rf"(?:{name})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    spans = [("assign", *m.span()) for m in found(assign, text) if len(m[1]) >= 8]
    spans += [("access", *m.span()) for m in found("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [("hex", *m.span()) for m in found("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(spans)


def plain_pii(text):
    spans = [("email", *m.span()) for m in found(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in found(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            spans.append(("ip", *m.span()))
    for m in found(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and pii.luhn(digits):
            spans.append(("card", *m.span()))
    for m in found(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            spans.append(("phone", *m.span()))
    return sorted(spans)


PIECES = [
    "a@b.c", ".", "@", "1", "23.4.5.6", "256.1.1.1", "+1 (555) 123-4567", "4111111111111111",
    "4111 1111-1111 1111", "-", " ", "  ", "password", "token=", "secret:", '"', "'", "=", "AKIA",
    "AKIA0123456789ABCD", "deadbeef" * 4, "é", "\n", "x", "api_key", "ſecret=", "abcdefgh", "0", "+", "()",
    "Api-", "apiKey: ",
]


def test_base_spans_equal_plain_patterns():
    rng = random.Random(3)
    for _ in range(20_000):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14)))
        assert sorted(s[:3] for s in secret_scan.base_spans(text)) == plain_secrets(text), text
        assert sorted(pii.base_matches(text)) == plain_pii(text), text


@pytest.mark.parametrize(
    "text, literal, kind",
    [
        ('db_password = "hX9#kk2!pQz"', "hX9#kk2!pQz", "literal"),
        ('{"client_secret": "Zk3uTq9wLm21"}', "Zk3uTq9wLm21", "literal"),
        ("<auth_token>q8Wz71LmTx02</auth_token>", "q8Wz71LmTx02", "literal"),
        ('a = "Zk3uTq9" + "wLm21x"\nauth_token = a\n', 'Zk3uTq9" + "wLm21x', "constant"),
        ("setSecret(api_secret, 'Zk3uTq9wLm21')", "Zk3uTq9wLm21", "literal"),
    ],
)
def test_assignments_are_read(text, literal, kind):
    spans = [s for s in secret_scan.find_secrets(text) if not s[3]]
    assert [(text[a:b], k) for k, a, b, *_ in spans] == [(literal, kind)]


@pytest.mark.parametrize("text", ['colour = "hX9#kk2!pQz"', 'password = "changeme"', "token: <your token>", "a == b"])
def test_harmless_assignments(text):
    assert not [s for s in secret_scan.find_secrets(text) if not s[3]]


def test_account_numbers_need_a_checksum():
    assert [s[0] for s in pii.find_pii("IBAN DE89 3704 0044 0532 0130 00.")] == ["iban"]
    assert pii.find_pii("IBAN DE88 3704 0044 0532 0130 00.") == []
    assert [s[0] for s in pii.find_pii("his ssn 123-45-6789")] == ["national_id"]
    assert pii.find_pii("part 123-45-6789") == []


def test_context_moves_the_score():
    near, far = pii.find_pii("server 10.0.0.1")[0][4], pii.find_pii("version 10.0.0.1")[0][4]
    assert near > far


def test_redaction_hides_every_span(spark):
    text = "x password=abcdefgh12 y AKIA0123456789ABCD é token='Zk3uTq9wLm21'."
    rows = frame(spark, [(1, text, None, None), (2, "clean", None, None), (3, None, None, None)])
    out = {r.doc_id: r.text for r in secret_scan.redact(secret_scan.scan_secrets(rows)).collect()}
    assert out == {1: "x <secret> y <secret> é <secret>'.", 2: "clean", 3: None}


@pytest.mark.parametrize("scan", [secret_scan.scan_secrets, pii.scan_pii])
def test_scans_of_awkward_rows(spark, scan):
    rows = frame(spark).withColumn("spans", F.lit("mine")).withColumn("start", F.lit(1))
    out = scan(rows).collect()
    assert len(out) == len(AWKWARD)
    assert all(r.spans == [] and r.start == 1 for r in out)
    assert scan(frame(spark, [])).count() == 0


# --- quality


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    covered = {k + i for k, r in enumerate(runs) if runs.count(r) > 1 for i in range(3)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, again, len(covered)


def test_counts_equal_plain_counts():
    rng = random.Random(5)
    for _ in range(3_000):
        text = "".join(rng.choice(["a", "b ", " ", "\n", "é ", "\x0b", "\x85", "#", "\u2028", "b a "]) for _ in range(rng.randint(0, 40)))
        assert quality.counts(text)[:5] == plain_counts(text), repr(text)


def test_outliers_go_and_clean_rows_stay(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("etaoin") for _ in range(rng.randint(2, 9)))
    rows = [
        (k, " ".join(word() for _ in range(rng.randint(60, 400))), "en", "a" if k % 3 else "b")
        for k in range(900)
    ]
    rows += [(1000 + k, " ".join(word() + "###" for _ in range(100)), "en", "a") for k in range(60)]
    out = {r.doc_id: r for r in quality.judge_quality(frame(spark, rows)).collect()}
    assert all(out[k].kept for k in range(900))
    assert not any(out[1000 + k].kept for k in range(60))


def test_robust_estimate_equals_one_machine(spark):
    """The distributed concentration steps against the same steps in memory."""
    import numpy as np

    rng = np.random.default_rng(2)
    p = len(quality.STATISTICS)
    data = np.rint(rng.normal(200, 40, (600, p)) + rng.normal(0, 20, (600, 1))).astype(int)
    data[:80] += 900
    names = ", ".join(f"{x} long" for x in quality.STATISTICS)
    rows = spark.createDataFrame([("g", *map(int, r)) for r in data], f"grp string, {names}")
    got = quality.robust_estimates(rows, 1).first()

    floor = np.diag(np.square(np.array(quality.FLOOR) * quality.STEP))
    mean = np.median(data, axis=0)
    inverse = np.diag(1 / ((1.4826 * np.median(abs(data - mean), axis=0)) ** 2 + np.diag(floor)))

    def distances():
        return np.einsum("ij,jk,ik->i", data - mean, inverse, data - mean)

    def refit(inside, factor):
        part = data[inside]
        return part.mean(axis=0), np.linalg.inv(np.cov(part.T, bias=True) * factor + floor)

    for _ in range(quality.ROUNDS):
        level = np.floor(np.log2(distances() + 2.0**-10) * 8)
        inside = level <= np.ceil(np.percentile(level, 100 * quality.KEPT))
        mean, inverse = refit(inside, quality.consistency(quality.KEPT))
    mean, inverse = refit(distances() <= quality.INSIDE, quality.consistency(0.975))
    assert np.allclose(got["mean"], mean)
    assert np.allclose(got["inverse"], inverse.ravel())
    assert abs(np.array(got["mean"]) - 200).max() < 10


def test_quality_of_awkward_rows(spark):
    rows = frame(spark).withColumn("distance", F.lit(9)).withColumn("extra", F.lit("e"))
    out = quality.judge_quality(rows.drop("distance")).collect()
    assert len(out) == len(AWKWARD)
    assert not any(r.kept for r in out if r.n_words < 50)
    assert all(r.extra == "e" for r in out)
    assert quality.judge_quality(frame(spark, [])).count() == 0


def test_chi_square():
    assert abs(quality.chi_square_quantile(0.975, 5) - 12.8325) < 1e-3
    assert abs(quality.chi_square_cdf(11.0705, 5) - 0.95) < 1e-4


# --- language

SAMPLES = {
    "en": "the quick brown fox jumps over the lazy dog and then they went with her to the house",
    "de": "der schnelle braune fuchs springt über den faulen hund und dann ging sie nicht nach hause",
    "fr": "le renard brun rapide saute par dessus le chien paresseux et puis elle est dans la maison",
    "es": "el rápido zorro marrón salta sobre el perro perezoso y después ella está en la casa",
}


def test_language_on_held_out_rows(spark):
    rng = random.Random(4)
    rows = []
    for lang, text in SAMPLES.items():
        for _ in range(60):
            words = text.split()
            rng.shuffle(words)
            rows.append((len(rows), " ".join(words[:8]), lang, None))
    known = [r for r in rows if r[0] % 4]
    model = language.fit(frame(spark, known + [(9999, "x", None, None)]), F.col("doc_id"))
    assert model.families == ["germanic", "romance"]
    assert set(model.names) == {"family:germanic", "family:romance", "pair:de:en", "pair:es:fr"}
    out = language.predict(frame(spark, [r for r in rows if r[0] % 4 == 0]), model).collect()
    assert sum(r.lang_pred == r.lang for r in out) >= 0.9 * len(out)
    assert all(0 <= r.score <= 1 for r in out)

    clash = frame(spark).withColumn("score", F.lit("mine"))
    odd = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(clash, model).collect()}
    assert odd[1] == odd[2] == odd[3] == odd[7] == ("und", 0.0)
    assert language.predict(frame(spark, []), model).count() == 0


def test_accuracy_on_held_out_documents(spark):
    """On the table itself, by rows that were not learned from."""
    documents = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = language.fit(documents.filter(~fold), F.col("doc_id"))
    told = language.predict(documents.filter(fold & F.col("lang").isNotNull()), model)
    right = told.filter("lang_pred != 'und'").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.95


def test_too_many_labels_are_refused(spark):
    rows = [(k, "words here", f"l{k}", None) for k in range(language.MOST_LABELS + 1)]
    with pytest.raises(ValueError, match="languages"):
        language.fit(frame(spark, rows), F.col("doc_id"))


def test_few_languages(spark):
    none = language.fit(frame(spark, []), F.col("doc_id"))
    assert none.predict("words") == ("und", 0.0)
    one = language.fit(frame(spark, [(1, "words", "en", None)]), F.col("doc_id"))
    assert one.predict("words") == ("en", 0.5)
    assert one.predict("12") == ("und", 0.0)


# --- BPE


def test_bpe_equals_the_library(spark):
    library = Tokenizer.from_file(PATH)
    rng = random.Random(6)
    every = "".join(map(chr, [*range(1, 0xD800), *range(0xE000, 0x11000, 3)]))
    texts = [
        "", " ", LONG, every, " ".join(every), "a<|endoftext|>b <|STARTOFTEXT|> <|startoftext|>",
        "don't I'LL 'S 12٣", "x" * 3000, "e\u0301 \u1ea1\u0307 \u0391\u03a3 \u0130 \xdf",
    ]
    texts += ["".join(rng.choice("etaoinshr.,'! \n\xe9\xdf7") for _ in range(60)) for _ in range(200)]
    rows = frame(spark, [(k, t, None, None) for k, t in enumerate(texts)]).withColumn("ids", F.lit(1))
    out = {r.doc_id: r for r in bpe.decode(bpe.encode(rows, PATH), PATH).collect()}
    for k, text in enumerate(texts):
        ids = library.encode(text, add_special_tokens=False).ids
        assert out[k].ids == b"".join(i.to_bytes(4, "little") for i in ids), text[:40]
        assert out[k].decoded == library.decode(ids, skip_special_tokens=False)


def test_bpe_of_awkward_rows(spark):
    out = bpe.decode(bpe.encode(frame(spark).withColumn("decoded", F.lit(1)), PATH), PATH).collect()
    assert len(out) == len(AWKWARD)
    assert all(r.ids == b"" and r.decoded == "" for r in out if r.doc_id in (1, 2, 3))
    assert bpe.encode(frame(spark, []), PATH).count() == 0


def test_tree_gives_lowest_then_leftmost():
    rng = random.Random(7)
    for size in (1, 2, 3, 9, 16):
        keys = [rng.randint(0, 50) for _ in range(size)]
        tree = bpe.PairTree(list(keys))
        for _ in range(50):
            assert tree.tree[1] == min(keys)
            k = rng.randrange(size)
            keys[k] = rng.choice([bpe.NONE, rng.randint(0, 50)])
            tree.put(k, keys[k])


# --- licenses


def grams(text):
    w = re.findall(r"[^\W_]+", text.lower())
    return {tuple(w[k : k + 3]) for k in range(max(1, len(w) - 2))} if w else set()


def scanned(spark, rows, known=None):
    known = known or licenses.templates(spark)
    out = {}
    for r in licenses.scan_licenses(frame(spark, rows), known).collect():
        out.setdefault(r.doc_id, {})[r.license] = r.containment
    return out


def test_licenses_against_all_shingles_of_all_templates(spark):
    """A text holds its own template's license, and no license that its shingles do not hold."""
    filler = " ".join(f"w{k}" for k in range(300))
    templates = sorted(licenses.template_rows())
    rng = random.Random(8)
    rows = []
    for k, (_, text) in enumerate(templates):
        words = text.split()
        if k % 3 and len(words) > 12:
            words[rng.randrange(len(words))] = "changed"
        rows.append((k, f"{filler[: 7 * k]} {' '.join(words)} {filler}", None, None))
    rows += [(1000, filler, None, None), (1001, "Released under the GNU", None, None), *((None, *r[1:]) for r in AWKWARD)]
    out = scanned(spark, rows)
    assert set(out) == {r[0] for r in rows[: len(templates)]}
    for k, (name, own) in enumerate(templates):
        held = grams(rows[k][1])
        want = {}
        for license_, text in templates:
            share = len(held & grams(text)) / len(grams(text))
            if share >= licenses.CONTAINED:
                want[license_] = max(share, want.get(license_, 0))
        assert set(out[k]) <= set(want), own
        assert all(out[k][x] <= want[x] for x in out[k]), own
        # What is left out lies within something that says more.
        for left in set(want) - set(out[k]):
            assert any(out[k][x] >= want[left] for x in out[k]), (own, left)
        if name in want:
            assert name in out[k] or max(out[k].values()) >= want[name], own


def test_license_containment_is_exact(spark):
    text = dict(licenses.TEXTS)["GPL-notice"]
    words, rng, rows = text.split(), random.Random(8), []
    for k in range(60):
        some = list(words)
        for _ in range(k % 6):
            some[rng.randrange(len(some))] = "changed"
        rows.append((k, "some words before " + " ".join(some) + " and after", None, None))
    known = spark.createDataFrame([("GPL-notice", text)] * 2, "license string, text string")
    want = {k: len(grams(t) & grams(text)) / len(grams(text)) for k, t, *_ in rows}
    assert scanned(spark, rows, known) == {k: {"GPL-notice": v} for k, v in want.items() if v >= licenses.CONTAINED}


@pytest.mark.parametrize(
    ("text", "license_"),
    [
        ("This project is Licensed under the MIT License, see below", "MIT"),
        ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"),
        ("# SPDX-License-Identifier: Apache-2.0\nimport os", "Apache-2.0"),
        ("// SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0-or-later"),
        ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "CC-BY-NC-4.0"),
        ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "CC-BY-4.0"),
        ("Released under the MIT License.", "MIT"),
        ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
    ],
)
def test_short_notices_give_one_license(spark, text, license_):
    assert list(scanned(spark, [(1, f"words before it. {text}\nand after", None, None)])[1]) == [license_]


def test_both_licenses_of_a_text_that_holds_both(spark):
    nc = "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."
    by = "This work is licensed under a Creative Commons Attribution 4.0 International License."
    text = nc + " and other words go here " * 9 + by
    assert set(scanned(spark, [(1, text, None, None)])[1]) == {"CC-BY-NC-4.0", "CC-BY-4.0"}


def test_no_licenses(spark):
    assert licenses.scan_licenses(frame(spark, []), licenses.templates(spark)).count() == 0
    none = spark.createDataFrame([("x", None), ("y", ""), (None, "a b c d")], "license string, text string")
    assert licenses.scan_licenses(frame(spark), none).count() == 0


# --- chats


def test_texts_come_back(spark):
    texts = [CONTROL_CHAT, None, "", "a & b <turn> &lt; &amp;lt; </turn><loss>", LONG]
    rows = [(k, n, role, t) for k, t in enumerate(texts) for n, role in enumerate(["user", "assistant"])]
    rows += [(90, None, None, "x"), (90, 0, "<b>&", "tie"), (90, 0, "<b>&", "tie"), (None, 1, "assistant", "null id")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = turns.withColumn("parts", chat.text_parts(F.col("text"))).withColumn("formatted", F.lit(0))
    out = chat.format_chats(turns).withColumn("back", chat.read_back(F.col("formatted"))).collect()
    got = {r.conv_id: r for r in out}
    for k, text in enumerate(texts):
        assert [(b.role, b.text, b.learned) for b in got[k].back] == [("user", text or "", False), ("assistant", text or "", True)]
        (span,) = got[k].loss_spans
        raw = got[k].formatted[span.start : span.end]
        assert raw.replace("&lt;", "<").replace("&amp;", "&") == (text or "")
    assert [(b.role, b.text) for b in got[90].back] == [("", "x"), ("<b>&", "tie"), ("<b>&", "tie")]
    assert chat.format_chats(turns.limit(0)).count() == 0


def test_parts_become_placeholders(spark):
    parts = [
        ("text", "see ", None, None), ("image", None, "s3://a", 2), ("audio", None, "b", None),
        None, ("text", None, None, None), ("odd", None, "c", 3),
    ]
    turns = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, parts {chat.PART}")
    row = chat.format_chats(turns).first()
    assert row.formatted == "<turn>user<body>see <part 0 image><part 1 audio><part 2 odd></turn><turn>assistant<loss></turn>"
    assert [tuple(a) for a in row.attachments] == [(0, 0, "image", "s3://a", 1152), (0, 1, "audio", "b", 25), (0, 2, "odd", "c", 3)]
