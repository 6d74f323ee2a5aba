import random
import re

from rankforge.llm import secret_ledger as s
from tests.llm.helpers import awkward, docs, prose

ASSIGN = re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute(text):
    text = text or ""
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def sample(seed=1):
    rnd = random.Random(seed)
    bits = ['password = "hunter22"', "secret=token:abcdefgh", "API_KEY: 'abc", "apikey==x", "token  :  " + "f" * 30, "AKIA" + "Z9" * 8, "AKIAAKIA" + "A" * 7, "AKIA" + "B" * 15,
            "0123456789abcdef" * 2, "a" * 23, "é" * 3, "\U0001F600", "paſſwd=abcdefgh", "PassWd='" + "0a" * 14 + "'", "\n", "secret\n= abcdefg"]
    return [(100 + i, "".join(rnd.choice(bits + [prose(rnd, 2)]) + rnd.choice(["", " ", "x"]) for _ in range(rnd.randint(0, 12)))) for i in range(150)]


def test_spans_against_brute_force(spark):
    rows = awkward() + sample()
    out = s.secrets(docs(spark, rows)).collect()
    got = sorted(((r.doc_id, [tuple(f) for f in r.found]) for r in out), key=str)
    assert got == sorted(((i, brute(t)) for i, t in rows), key=str)
    assert s.secrets(docs(spark, [])).collect() == []


def test_ledger_scans_only_what_it_has_not_seen(spark):
    rows = sample()
    ledger = s.Ledger(spark)
    ledger.scan(docs(spark, rows[:100] + rows[:50]))
    n = ledger.seen().count()
    assert n == len({t for _, t in rows[:100]}) * 3
    ledger.scan(docs(spark, rows[:100]))
    assert ledger.seen().count() == n
    ledger.scan(docs(spark, rows))
    assert ledger.seen().count() == len({t for _, t in rows}) * 3
    raised = (s.RULES[0], s.Rule("access", 2, r"AKIA[A-Z0-9]{16}"), s.RULES[2])
    ledger.scan(docs(spark, rows), rules=raised)
    assert ledger.seen().where("version = 2").count() == len({t for _, t in rows})
    out = s.secrets(docs(spark, rows), ledger=ledger).collect()
    assert sorted((r.doc_id, [tuple(f) for f in r.found]) for r in out) == sorted((i, brute(t)) for i, t in rows)


def test_redaction(spark):
    rows = sample(2) + awkward()
    out = s.redact(docs(spark, rows)).collect()
    def cut(t):
        if t is None:
            return None
        spans = []
        for a, _, b, _ in brute(t):
            if spans and a < spans[-1][1]:
                spans[-1][1] = max(b, spans[-1][1])
            else:
                spans.append([a, b])
        for a, b in spans[::-1]:
            t = t[:a] + s.MASK + t[b:]
        return t
    assert sorted(((r.doc_id, r.text, r.n_chars) for r in out), key=str) == sorted(((i, cut(t), len(cut(t) or "")) for i, t in rows), key=str)


def test_no_python_in_the_plan(spark):
    plan = s.redact(docs(spark, sample()[:5], extra=False))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_a_ledger_opened_again_takes_up_its_commits(spark, tmp_dir):
    import os

    rows = sample(3)
    s.Ledger(spark, f"{tmp_dir}/ledger").scan(docs(spark, rows[:90]))
    os.makedirs(f"{tmp_dir}/ledger/commit-000001")  # an append that didn't finish
    again = s.Ledger(spark, f"{tmp_dir}/ledger")
    assert again.seen().count() == len({t for _, t in rows[:90]}) * 3
    again.scan(docs(spark, rows[:90]))
    assert spark.read.parquet(again.commits[-1]).count() == 0
    out = s.secrets(docs(spark, rows), ledger=s.Ledger(spark, f"{tmp_dir}/ledger")).collect()
    assert sorted((r.doc_id, [tuple(f) for f in r.found]) for r in out) == sorted((i, brute(t)) for i, t in rows)
    last = s.Ledger(spark, f"{tmp_dir}/ledger")
    assert last.seen().count() == len({t for _, t in rows}) * 3 and len(last.commits) == 3


def test_many_matches_in_one_text_take_linear_time(spark):
    import time

    def text(n):
        return "".join(f"é\U0001F600 token=abc{i:06d} " + "0123456789abcdef" * 2 + "\n" for i in range(n))

    took = {}
    for n in (100, 20000):  # the first also warms up
        rows = [(1, text(n)), (2, "x" * 3000 + "AKIA" + "Z" * 16), (3, "AKIA" + "Z" * 1020)]
        began = time.monotonic()
        got = {r.doc_id: r for r in s.redact(docs(spark, rows, extra=False)).collect()}
        spans = {r.doc_id: r.found for r in s.secrets(docs(spark, rows, extra=False)).collect()}
        took[n] = time.monotonic() - began
        assert got[1].text == f"é\U0001F600 {s.MASK} {s.MASK}\n" * n and got[2].text == "x" * 3000 + s.MASK and got[3].text == s.MASK
        assert [tuple(x) for x in spans[1]] == brute(rows[0][1])
    assert took[20000] < took[100] + 20  # 1.2 MB with 40,000 matches; in square time more than a minute
