"""Archives of other writers, every code point, identifiers as people write them."""

import base64
import hashlib
import io
import random
import zlib

import public_tokenizers
import pytest

from mailweave.llm import bpe, pii, warc
from mailweave.llm.queries import WORD_BPE


def member(headers, block=b"", length=None):
    lines = [b"WARC/1.0"] + [f"{k}: {v}".encode() for k, v in headers.items()]
    if length is not False:
        lines.append(f"Content-Length: {len(block) if length is None else length}".encode())
    raw = b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(wbits=31)
    return z.compress(raw) + z.flush()


def records(*members):
    return list(warc.read_records(io.BytesIO(b"".join(members)), keep_payload=True))


HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
PAGE = {"WARC-Type": "response", "Content-Type": "application/http; msgtype=response"}


def test_other_writers_archives():
    body = b"<p>x</p>"
    sha1 = base64.b32encode(hashlib.sha1(body).digest()).decode()
    got = records(member({"WARC-Type": "warcinfo", "Content-Type": "application/warc-fields"}, b"software: other\r\n"),
                  member(PAGE, HTTP + body), member({"WARC-Type": "metadata"}, b""),
                  member({**PAGE, "WARC-Payload-Digest": "sha1:" + sha1.lower()}, HTTP + body),
                  member({**PAGE, "WARC-Payload-Digest": "sha256:" + hashlib.sha256(body).hexdigest()}, HTTP + body),
                  member({**PAGE, "WARC-Payload-Digest": "sha-1:" + hashlib.sha1(body).hexdigest()}, HTTP + body),
                  member({**PAGE, "WARC-Payload-Digest": "odd:xyz", "WARC-Block-Digest": "md5:" + hashlib.md5(HTTP + body).hexdigest()}, HTTP + body),
                  member({**PAGE, "WARC-Truncated": "length", "WARC-Payload-Digest": "sha1:" + "A" * 32}, HTTP + body[:3]))
    assert [r.headers["warc-type"] for r in got] == ["warcinfo", "response", "metadata"] + ["response"] * 5
    assert [r.payload for r in got] == [b"software: other\r\n", body, b"", *[body] * 4, body[:3]]
    assert {got[k].payload_digest for k in (1, 3, 4, 5, 6)} == {sha1}


@pytest.mark.parametrize("bad", [
    member(PAGE, HTTP + b"x", length=False), member(PAGE, HTTP + b"x", length="few"),
    member({**PAGE, "WARC-Payload-Digest": "sha1:" + "A" * 32}, HTTP + b"x"),
    member({**PAGE, "WARC-Block-Digest": "sha256:" + "0" * 64}, HTTP + b"x"), member({}, b"", length=3)])
def test_broken_archives_are_refused(bad):
    with pytest.raises(ValueError):
        records(bad)


def test_every_code_point_is_encoded_as_the_library_does():
    from tokenizers import Tokenizer
    path = public_tokenizers.path(WORD_BPE)
    theirs, own = Tokenizer.from_file(path), bpe.tokenizer(path)
    theirs.no_truncation()
    theirs.no_padding()
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 20_000):
        part = [f"a{chr(c)}b {chr(c)}1" for c in points[at:at + 20_000]]
        for text, e in zip(part, theirs.encode_batch(part, add_special_tokens=False)):
            assert list(own.encode(text)) == e.ids, text
    rng = random.Random(6)
    mixed = ["".join(chr(rng.choice(points)) if rng.random() < 0.5 else rng.choice("aB1 '<|é́\n") for _ in range(40)) for _ in range(3000)]
    for text, e in zip(mixed, theirs.encode_batch(mixed, add_special_tokens=False)):
        assert list(own.encode(text)) == e.ids and own.decode(e.ids) == theirs.decode(e.ids, skip_special_tokens=False)


def test_recall_and_precision_of_cued_identifiers():
    """Identifiers and secrets as people write them, in texts made from
    patterns; prose with the same cue words must stay clean."""
    rng = random.Random(12)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    forms = ["account number: {d}", "Account No. {d}", "acct {d}", "ACCT NO {d}", "account is {d}", "passport number {d}", "SSN: {s}",
             "iban: DE{d}", "Passport: X{d}"]
    secrets = ["password: {p}", "Password is {p}", "api_key={p}", "API Key: {p}", "token = \"{p}\"", "Secret_Key: {p}", "passwd={p}"]
    clean = ["on account of the weather in 2024", "the account manager said 12 things", "accounting 123456789a", "password reset page",
             "token ring 1234", "a token of appreciation: wonderful days", "my passport is blue", "api key rotation policy",
             "the password is forgotten", "account: see below", "no account number was given here"]
    found = wrong = total = 0
    for _ in range(300):
        d, p = digits(rng.randrange(8, 13)), "".join(rng.choice("abcdefXYZ") for _ in range(6)) + digits(2)
        form = rng.choice(forms + secrets)
        value = {"d": d, "p": p, "s": f"{digits(3)}-{digits(2)}-{digits(4)}"}
        text = f"{rng.choice(clean)}. {form.format(**value)}, and more"
        want = [value[k] for k in value if "{%s}" % k in form]
        got = [text[s:e] for s, k, e in pii.find(text) if pii.KINDS[k] == "account"]
        total += 1
        found += any(g.endswith(want[0]) for g in got)
        wrong += sum(not g.endswith(want[0]) for g in got)
    assert (found / total, wrong) == (1.0, 0)
    assert [t for t in clean if any(k > 3 for _, k, _ in pii.find(t))] == []


def test_userinfo_against_a_plain_parser():
    from urllib.parse import urlsplit
    rng = random.Random(3)
    for _ in range(300):
        user = "".join(rng.choice("abc1.-") for _ in range(rng.randrange(0, 6)))
        secret = rng.choice(["", ":" + "".join(rng.choice("xyz9") for _ in range(5))])
        url = f"http{rng.choice(['', 's'])}://{user}{secret}{rng.choice(['@', '@', ''])}host.example/p"
        want = urlsplit(url).netloc.rpartition("@")[0]
        got = [url[s:e] for s, k, e in pii.find(url) if pii.KINDS[k] == "userinfo"]
        assert got == ([want] if want else [])


def test_case_folding_keeps_places():
    for text in ("İPASSWORD: hunter22", "ẞ Account NO: 12345678", "İİ acct 87654321 İ"):
        assert len(pii.folded(text)) == len(text)
    text = "İİ acct 87654321 İ"
    assert [text[s:e] for s, _, e in pii.find(text)] == ["87654321"]
