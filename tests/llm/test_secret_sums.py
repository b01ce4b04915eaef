"""Sums of constants that stand far from each other, and very many constants."""

from __future__ import annotations

import pytest

from millrace.llm import secret_scan

CLEAN = "the harbour was calm and the boats came home. " * 100


def own_spans(text):
    return [s for s in secret_scan.find_secrets(text) if not s[3]]


@pytest.mark.parametrize(
    "text, hidden",
    [
        ('base = "Zk3uTq9w"\n{c}\npassword = base + "Lm21xY"\n', ["Zk3uTq9w", "Lm21xY"]),
        ('a = "Zk3uTq9w"\n{c}\nb = a + "Lm21xY"\n{c}\nauth_token = b\n', ["Zk3uTq9w", "Lm21xY"]),
        ('a = "Zk3uTq9w"\n{c}\nb = "q8Wz" + "71Lm"\n{c}\nclient_secret = a + b\n', ["Zk3uTq9w", 'q8Wz" + "71Lm']),
    ],
)
def test_text_between_the_parts_of_a_sum_stays(spark, text, hidden):
    whole = text.format(c=CLEAN)
    assert sorted(whole[a:b] for _, a, b, *_ in own_spans(whole)) == sorted(hidden)
    frame = spark.createDataFrame([(1, whole)], "doc_id long, text string")
    want = whole
    for part in hidden:
        want = want.replace(part, "<secret>")
    assert secret_scan.redact(secret_scan.scan_secrets(frame)).first().text == want


def test_a_constant_passed_on_by_doubling_is_marked_once():
    text = 'a0 = "Zk3uTq9w"\n' + "".join(f"a{k + 1} = a{k} + a{k}\n" for k in range(6)) + "password = a6\n"
    assert [text[a:b] for _, a, b, *_ in own_spans(text)] == ["Zk3uTq9w"]


def test_constants_have_no_greatest_number():
    text = "".join(f"n{k} = {k}\n" for k in range(100_001))
    text += 'base = "Zk3uTq9wLm21"\nn7 = "q8Wz71LmTx02"\npassword = base\nauth_token = n7\n'
    assert [text[a:b] for _, a, b, *_ in own_spans(text)] == ["Zk3uTq9wLm21", "q8Wz71LmTx02"]


@pytest.mark.parametrize(
    "text",
    [
        "x" * 300 + '_password = "hX9#kk2!pQz"',
        "db_password" + " " * 200 + "=" + "\t" * 200 + '"hX9#kk2!pQz"',
        "<" + "x" * 300 + "_password>hX9#kk2!pQz</" + "x" * 300 + "_password>",
        "setSecret(" + " " * 40 + "x" * 300 + "_password" + " " * 40 + "," + " " * 40 + '"hX9#kk2!pQz")',
        'base = "hX9#"' + " " * 100 + "+" + " " * 100 + '"kk2!pQz"\npassword = base',
    ],
)
def test_names_and_blanks_have_no_greatest_length(text):
    assert [text[a:b].replace('"', "").replace(" ", "").replace("+", "") for _, a, b, *_ in own_spans(text)] == ["hX9#kk2!pQz"]


@pytest.mark.parametrize("piece", ["a" * 1000 + " ", "a ", " ", "\t", "<a", "<a>", "set(", "set(a,", '"', "a=", "a:=", "a=\"", "setx"])
def test_long_runs_take_time_in_proportion(piece):
    from time import process_time

    took = []
    for size in (100_000, 400_000):
        began = process_time()
        secret_scan.find_secrets("set = " + piece * (size // len(piece)))
        took.append(process_time() - began)
    assert took[1] < 12 * took[0] + 0.5
