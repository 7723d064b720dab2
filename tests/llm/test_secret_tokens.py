"""Operator 9 against plain patterns, and planted strings."""
import hashlib
import re

import cases
from cases import SF
from kinlink.llm import queries, secret_tokens as S

PATH = queries.SECRET_VOCABULARY


def plain_base(text):
    text = text or ""
    low = r"""[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"""
    assign = [m for m in re.finditer(f"({low})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    access = [m for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    hexes = [m for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted((m.start(), k, m.end()) for k, found in enumerate((assign, access, hexes)) for m in found)


TEXTS = ["password=abcdef", "PassWD : 'abc.def'", "secret=token:abcdefgh", "token==abcdef", "token = abc", "api_key=\"A/b+c=\"", "apikey:xxxxxx",
         "ſecret=abcdefg toKen=abcdefg", "AKIA" + "A1" * 8, "AKIA" + "B" * 15, "xAKIAAKIA" + "C" * 16, "f" * 24, "F" * 24 + "0" * 23, "é password: 日abcdefg",
         "password\n=abcdef", "a" * 100 + "=" + "b" * 10, "token: " + "0123456789abcdef" * 3, "secret : \x20\x20'q1w2e3r4'", "=", "passwordpassword=secretsecret=xxxxxx"]


def test_base_spans():
    for text in [*TEXTS, *(t for _, t, *_ in cases.awkward())]:
        got = [s for s in S.scan(text, PATH, 2.2) if s[1] < 3]
        assert got == plain_base(text), text


def test_token_efficiency():
    kinds = lambda t: [S.KINDS[k] for _, k, _ in S.scan(t, PATH, 2.2)]
    assert kinds("key ghp9Xk2Lq8ZvR4tY7wB1nM6cD3fG5hJ0 end") == ["random"]
    assert kinds("x dGhpc0lzUjRuZDBtU3RyMW5nOTk4 y") == ["random"]
    for clean in ("customer_account_table_2024", "550e8400-e29b-41d4-a716-446655440000", "D41D8CD98F00B204E9800998ECF8427E",
                  "4539578763621486", "internationalisation", "the-quick-brown-fox-jumps-over", "2024-01-02T03:04:05"):
        assert "random" not in kinds(f"see {clean} there"), clean


def test_awkward_rows_and_whole_table(spark, awkward):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in queries.op9_secrets(spark, SF).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        base = plain_base(text)
        joined = ",".join(f"{S.KINDS[k]}:{a}:{b}" for a, k, b in base)
        r = got[i]
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == n for _, k, _ in base) for n in range(3))
        assert set(joined.split(",")) <= set(r.spans.split(","))
    assert S.find_secrets(awkward, PATH).count() == awkward.count()


def test_redact(spark, empty):
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(TEXTS)] + [(None, None, None, None, None)]
    df = cases.frame(spark, rows)
    got = S.redact(df, PATH).collect()
    assert S.redact(df, PATH).columns == df.columns and len(got) == len(rows)
    for (i, t, *_), r in zip(rows, sorted(got, key=lambda r: (r.doc_id is None, r.doc_id))):
        assert plain_base(r.text) == []
        assert r.text == t if not plain_base(t) else "[REDACTED]" in r.text
        assert r.n_chars == (None if t is None else len(r.text))
    assert S.redact(empty, PATH).collect() == [] and S.find_secrets(empty, PATH).collect() == []


def test_keys_without_digits_beside_names_and_base_spans():
    def marked(text):
        return {i for a, _, b in S.scan(text, PATH, 2.2) for i in range(a, b)}

    keys = ("qXvZkTbWmRpLsDfG", "qXvZkTbWmRpLsDfGhJcNyVtQ", "KZXVQWJRTPLMNBHGFD", "aB/xKqZtWv+RpLmNsDfGhJcYk", "9Xk2Lq8ZvR4tY7wB1nM6cD3f")
    for key in keys:
        for glued in ("{}", "{}12345678", "/home/user/configuration/{}", "AWS_ACCESS_IDENTIFIER={}", "{}-" + "ab12" * 8, "x" + "ab12" * 8 + "/{}"):
            text = f"see {glued.format(key)} now"
            at = text.index(key)
            assert set(range(at, at + len(key))) <= marked(text), text
    assert S.scan("ZqXvKt" + "ab12" * 8 + "WmRp", PATH, 2.2) == [(0, 3, 6), (6, 2, 38), (38, 3, 42)]
    for clean in ("src/main/java/com/example/UserController", "getUserAccountByIdentifier", "MAX_CONNECTION_TIMEOUT_MS", "a/b/c/d/e/f/g/h/i/j",
                  "Geschwindigkeitsbegrenzung", "VERANTWORTUNGSBEWUSSTSEIN", "lorem_ipsum_dolor_sit_amet", "-----------------BEGIN"):
        assert not marked(clean), clean


def test_random_strings_are_found():
    import random
    import string
    r = random.Random(3)
    for letters in (string.ascii_lowercase, string.ascii_letters, string.ascii_letters + string.digits):
        for size in (16, 24, 40):
            texts = ["".join(r.choices(letters, k=size)) for _ in range(200)]
            assert sum(S.scan(t, PATH, 2.2) == [(0, 3, size)] for t in texts) >= 190


def test_many_hits_in_one_text():
    """10^5 assignments, and as many digests in one run: time in proportion to the hits."""
    import time
    vocabulary = queries.SECRET_VOCABULARY
    for one, kind in (("token=abc%05d ", 0), ("%024x-", 2)):
        taken = []
        for n in (20_000, 100_000):
            text = "".join(one % i for i in range(n))
            start = time.process_time()
            spans = S.scan(text, vocabulary, 2.2)
            taken.append(time.process_time() - start)
            assert sum(k == kind for _, k, _ in spans) == n
        assert taken[1] < 12 * taken[0] + 1
