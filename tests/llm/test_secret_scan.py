import base64
import hashlib
import json
import random
import re
import time

from veloframe.llm import secret_scan as S
from veloframe.llm.queries import op1_secret_scan

KINDS = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                          re.I | re.A), lambda m: len(m[2]) >= 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    "hex": (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
}


def brute(text):
    found = [(m.start(), k, kind, m.end()) for k, (kind, (pattern, keeps)) in enumerate(KINDS.items())
             for m in pattern.finditer(text) if keeps(m)]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def base(text):
    return [(k, s, e) for s, k, e in S.scan(text) if k in S.BASE_KINDS]


def test_base_kinds_equal_plain_search():
    r = random.Random(1)
    parts = ["password", "PassWord", "secret", "secretoken", "token", "api_key", "apikey", "API_KEY", "passwd", "=", ":",
             " ", "\"", "'", "x", "abc12", "abcdef", "AKIA", "akia", "0123456789ABCDEF", "deadbeef", "0a" * 12, "é", "İ",
             "ſ", "K", "\n", "/+=", "-", "0" * 23, "f" * 24, "to", "ken"]
    for _ in range(4000):
        text = "".join(r.choices(parts, k=r.randint(0, 14)))
        assert base(text) == brute(text), repr(text)


def test_checked_kinds_need_their_check_value():
    body = "A1b2C3d4E5f6G7h8I9j0K1l2M3n4O5"
    good = f"ghp_{body}{S.base62_crc(body)}"
    bad = good[:-1] + ("0" if good[-1] != "0" else "1")
    assert [k for _, k, _ in S.scan(f"x {good} y")] == ["checked"]
    assert S.scan(f"x {bad} y") == []
    part = base64.urlsafe_b64encode(json.dumps({"a": 1, "b": "cc"}).encode()).decode().rstrip("=")
    assert [k for _, k, _ in S.scan(f"{part}.{part}.{'s' * 20}")] == ["signed"]
    assert S.scan(f"eyJzzzz.eyJyyyy.{'s' * 20}") == []
    der = b"\x30\x82\x01\x00" + bytes(256)
    pem = "-----BEGIN PRIVATE KEY-----\n%s\n-----END PRIVATE KEY-----"
    assert [k for _, k, _ in S.scan(pem % base64.b64encode(der).decode())] == ["pem"]
    assert S.scan(pem % base64.b64encode(der[:-1]).decode()) == []


def test_redact_covers_every_span():
    text = "a token = \"" + "0f" * 15 + "\" b AKIA" + "Z" * 16 + " c"
    assert S.redact(text, S.scan(text)) == 'a [assign]" b [access] c'
    assert S.redact("clean", []) == "clean"


def test_query_on_edge_rows(spark, edge_docs, no_docs, folder):
    secret = edge_docs.limit(0)
    rows = {(r["doc_id"], r["spans"], r["base_sha256"]) for r in
            op1_secret_scan(spark, folder(documents=edge_docs.unionByName(secret))).collect()}
    assert len(rows) and all(s == "" and h == hashlib.sha256(b"").hexdigest() for _, s, h in rows)


def test_query_counts_and_empty_table(spark, no_docs, folder):
    assert op1_secret_scan(spark, folder(documents=no_docs)).count() == 0


def test_query_digest(spark, folder):
    text = "é password: abcdef and " + "a" * 30
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = op1_secret_scan(spark, folder(documents=docs)).first()
    joined = ",".join(f"{k}:{s}:{e}" for k, s, e in brute(text))
    assert (row["n_assign"], row["n_access"], row["n_hex"], row["spans"]) == (1, 0, 1, joined)
    assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()


def armour(label, body, headers=""):
    lines = base64.encodebytes(body).decode()
    return f"-----BEGIN {label}-----\n{headers}{lines}-----END {label}-----"


def spans(text, *keys):
    return [(text.index(k), "pem", text.index(k) + len(k)) for k in keys]


def test_key_after_a_cut_off_one():
    key = armour("RSA PRIVATE KEY", b"\x30\x82\x01\x00" + bytes(range(256)))
    for lone in ("-----BEGIN RSA PRIVATE KEY-----\n", key[:120] + "\n", "-----BEGIN RSA PRIVATE KEY-----", key[:-20],
                 "-----BEGIN EC PRIVATE KEY----- "):
        text = f"a {lone}{key} b"
        assert S.scan(text) == spans(text, key)
        assert S.redact(text, S.scan(text)) == f"a {lone}[pem] b"
    bad = armour("RSA PRIVATE KEY", b"\x30\x82\x01\x01" + bytes(256))
    other = armour("PRIVATE KEY", b"\x30\x03abc")
    text = f"{bad}\n{key}\n{other}\n{bad}"
    assert S.scan(text) == spans(text, key, other)


def test_signed_parts_after_failed_ones():
    part = base64.urlsafe_b64encode(json.dumps({"a": 1, "b": "cc"}).encode()).decode().rstrip("=")
    token = f"{part}.{part}.{'s' * 20}"
    assert S.scan(f"eyJzzzz.{token}") == [(8, "signed", 8 + len(token))]


def test_openssh_and_encrypted_keys():
    def field(x):
        return len(x).to_bytes(4, "big") + x

    def openssh(cipher=b"none", kdf=b"none", options=b"", keys=1, tag=b""):
        return (b"openssh-key-v1\0" + field(cipher) + field(kdf) + field(options) + keys.to_bytes(4, "big")
                + field(b"p" * 51) * keys + field(b"s" * 144) + tag)

    good = [openssh(), openssh(b"aes256-ctr", b"bcrypt", b"o" * 24), openssh(keys=2),
            openssh(b"chacha20-poly1305@openssh.com", b"bcrypt", b"o" * 24, tag=b"t" * 16)]
    for body in good:
        key = armour("OPENSSH PRIVATE KEY", body)
        assert S.scan(f"x {key} y") == [(2, "pem", 2 + len(key))]
    for body in (good[0][:-1], good[0] + b"x", good[0][:60], good[0][:15], openssh(keys=0), openssh(tag=b"t" * 16)):
        assert S.scan(armour("OPENSSH PRIVATE KEY", body)) == []
    headers = "Proc-Type: 4,ENCRYPTED\nDEK-Info: %s\n\n"
    aes, des = headers % f"AES-128-CBC,{'0A' * 16}", headers % f"DES-EDE3-CBC,{'0A' * 8}"
    found = [[k for _, k, _ in S.scan(armour("RSA PRIVATE KEY", b"c" * n, h)) if k == "pem"]
             for n, h in ((608, aes), (608, aes.replace("\n", "\r\n")), (600, des), (600, aes), (601, des), (0, aes), (608, ""))]
    assert found == [["pem"], ["pem"], ["pem"], [], [], [], []]
    assert [k for _, k, _ in S.scan(armour("EC PRIVATE KEY", b"\x30\x03abc", "Comment: mine\n\n"))] == ["pem"]


def test_query_and_redaction_keep_no_key(spark, folder):
    key = armour("RSA PRIVATE KEY", b"\x30\x82\x01\x00" + bytes(256))
    text = f"-----BEGIN RSA PRIVATE KEY-----\n...\n{key} end"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = op1_secret_scan(spark, folder(documents=docs)).first()
    start = text.index(key)
    assert row["spans"] == f"pem:{start}:{start + len(key)}"
    assert row["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert docs.select(S.redacted(docs["text"])).first()[0] == "-----BEGIN RSA PRIVATE KEY-----\n...\n[pem] end"


def test_signed_tokens_equal_plain_search():
    """Against a regex tried at every start."""
    plain = re.compile(r"(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]{16,})")
    r = random.Random(8)

    def part(size):
        raw = json.dumps({"k" * r.randrange(1, 4): "v" * r.randrange(size)}).replace(" ", "")
        return base64.urlsafe_b64encode(raw.encode()).decode().rstrip("=")

    for _ in range(400):
        text = "".join(r.choice((part(9), part(900), "eyJ", ".", "eyJeyJ", "x" * r.randrange(30), " ", "EYJ", ".eyJ9."))
                       for _ in range(r.randrange(1, 12)))
        want, done = [], 0
        for at in range(len(text)):
            m = plain.match(text, at)
            if at >= done and m and S.decodes(m[1]) and S.decodes(m[2]):
                done = m.end()
                want.append((at, "signed", done))
        assert [x for x in S.scan(text) if x[1] == "signed"] == want


def test_heads_reject_only_what_cannot_decode():
    r = random.Random(9)
    for _ in range(300):
        value = {"a": ["\u00e9\n\"" * r.randrange(200), -1.5e9, True, None], "b" * r.randrange(600): {"c": "\u6c34" * r.randrange(300)}}
        raw = json.dumps(value, ensure_ascii=r.random() < 0.5).encode()
        raw += b" " * (-len(raw) % 3)
        text = base64.urlsafe_b64encode(raw).decode()
        assert S.decodes(text)
        for n in range(4, len(text), 4):
            assert not S.cannot_decode(text[:n])


def test_time_grows_with_the_text():
    """Runs of token starts, alone and before what completes a token."""
    rest = "." + base64.urlsafe_b64encode(b'{"a":1}').decode().rstrip("=") + "." + "s" * 20
    for tail in ("", ".", rest):
        seen = []
        for n in (1 << 18, 1 << 20):
            text = "eyJ" * (n // 3) + tail
            begin = time.process_time()
            S.scan(text)
            seen.append(time.process_time() - begin)
        assert seen[1] < 12 * seen[0] + 1 and seen[1] < 30
