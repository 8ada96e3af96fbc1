"""Secret scans, token counts, chat formatting and the classifier."""

import hashlib
import random
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from factweave.llm import chat, quality, secret_scan
from factweave.llm.token_counts import token_counts
from factweave.llm.tokenizing import Pieces
from tests.conftest import SF_CHECK, SF_SMALL
from tests.llm import brute


def test_base_spans_of_every_text(spark, documents, texts):
    odd = ["token = 'abcdef'", "PassWord:x1", "API_KEY  =  \"k.k-k/k\"", "AKIA" + "A" * 16, "AKIA" + "A" * 15, "0" * 23, "0" * 24 + "g" + "f" * 30,
           "é secret=abcdef0123456789abcdef0123456789", "token=token=token=aaaaaa", "ſecret=abcdefgh", "password=" + "a" * 100_000]
    extra = spark.createDataFrame([(20_000 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    data = texts + [(20_000 + i, t) for i, t in enumerate(odd)]
    got = brute.rows(secret_scan.secret_scan(documents.select("doc_id", "text", "key").unionByName(extra.withColumn("key", F.lit(1))))
                     .select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256"))
    want = []
    for i, t in data:
        s = brute.base_spans(t)
        want.append((i, *[sum(x[0] == k for x in s) for k in ("assign", "access", "hex")], hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in s).encode()).hexdigest()))
    assert got == sorted(want, key=repr)


def test_weak_parts_need_a_complement():
    def kinds(t):
        return [p[0] for p in secret_scan.link(secret_scan.find_parts(t.encode()))]

    assert kinds("username: alice") == []
    assert kinds("password = abc") == []
    assert kinds("username: alice password = abc") == ["identifier", "weak_secret"]
    assert kinds("username: alice" + " " * 300 + "password = abc") == []
    assert kinds("see https://db.example.org/x for more") == []
    assert kinds("postgres://db.example.org/x password = abc") == ["endpoint", "weak_secret"]
    assert kinds("login: bob " + "0123456789abcdef" * 2) == ["identifier", "hex"]
    assert kinds("AKIAABCDEFGH and Ab1Ab1Ab1Ab1Ab1Ab1Ab1Ab1") == ["identifier", "weak_secret"]


@pytest.mark.parametrize("form", ["{}={}", "{}:{}", "{}: {}", "{} = {}", "{}='{}'", '{}="{}"', '"{}": "{}",', "export {}={}"])
def test_values_of_any_key_are_weak_secrets(form):
    value = "wJalrXUtnFEMI/K7MDENG+bPxRfiCYzzzzzzzzKEY=="
    for key in ("aws_secret_access_key", "pwd", "DB_KEY"):
        text = form.format("access_key_id", "ASIA12345678") + "\n" + form.format(key, value) + "\n"
        parts = secret_scan.link(secret_scan.find_parts(text.encode()))
        assert [p[0] for p in parts] == ["identifier", "weak_secret"] and value in text[parts[1][1]:parts[1][2]], text
        assert value not in secret_scan.replaced(text, parts, "#")
        assert secret_scan.link(secret_scan.find_parts(form.format(key, value).encode())) == []


def test_prefixed_keys_url_credentials_and_addresses():
    def spans(t):
        return [(k, t[s:e]) for k, s, e in secret_scan.reported(secret_scan.link(secret_scan.find_parts(t.encode())))]

    value = "Ab1" * 7
    assert spans(f"DB_USER=bob\nDB_PASS={value}") == [("identifier", "DB_USER=bob"), ("weak_secret", value)]
    assert spans(f"aws_access_key_id=ASIA12345678\nsession {value}") == [("identifier", "aws_access_key_id=ASIA12345678"), ("weak_secret", value)]
    assert spans("db_user=bob password=x1") == [("identifier", "db_user=bob"), ("weak_secret", "password=x1")]
    for url in ("https://user:hunter2@host.example/x", "postgres://bob:pw12@db:5432"):
        assert spans(f"see {url} now") == [("endpoint", url)]
        assert secret_scan.replaced(f"see {url} now", secret_scan.link(secret_scan.find_parts(f"see {url} now".encode())), "#") == "see # now"
    assert spans(f"bob@mail.example.org {value}") == [("identifier", "bob@mail.example.org"), ("weak_secret", value)]
    assert spans("write to bob@mail.example.org or ann@mail.example.org") == [] and spans("https://host.example/a:b") == []


def test_words_are_mixed_in_themselves():
    """A word of any length is tested whole, and by its own letters only."""
    for n in (15, 35, 400):
        word = "G1" * n + "ab"
        assert [p[0] for p in secret_scan.link(secret_scan.find_parts(f"user=bob key {word}".encode()))] == ["identifier", "weak_secret"]
    assert secret_scan.link(secret_scan.find_parts(b"user=bob GH1234567890GH1234567890 and some Words")) == []


def test_link_is_on_the_gap_between_intervals():
    random.seed(5)
    pieces = ["user=bob{} ", "token=a{} ", "0123456789abcdef{:03d} ", "https://h.example/{}" + "x" * 260 + " ", "https://h.example/cb?client_id=acme{}&sig=0123456789abcdef01 ", "token=" + "j.W" * 100 + "{} "]
    needs, role, scope = {"id": {"secret"}, "secret": {"id", "end"}, "end": {"secret"}}, secret_scan.ROLE, secret_scan.SCOPE
    for _ in range(40):
        text = "".join("." * random.randint(0, 500) + " " + random.choice(pieces).format(i) for i in range(30))
        parts = secret_scan.find_parts(text.encode())
        gap = lambda a, b: max(0, a[1] - b[2], b[1] - a[2])
        want = [p for p in parts if p[0] in secret_scan.BASE or any(role[q[0]] in needs[role[p[0]]] and gap(p, q) <= scope for q in parts)]
        assert secret_scan.link(parts) == want


def test_long_and_nested_parts_link():
    def spans(t):
        return [(k, t[s:e]) for k, s, e in secret_scan.reported(secret_scan.link(secret_scan.find_parts(t.encode())))]

    jwt = "token=" + "eyJ.x-Y" * 43
    assert spans(jwt + "\nuser=bob") == [("assign", jwt), ("identifier", "user=bob")]
    far = "https://h.example/" + "z" * 250
    assert spans(far + " 0123456789abcdef0123") == [("endpoint", far), ("weak_secret", "0123456789abcdef0123")]
    url = "https://h.example/cb?client_id=acme&sig=0123456789abcdef0123"
    assert spans("see " + url) == [("endpoint", url)]
    assert spans("https://h.example/cb?token=abcdefgh&sig=0123456789abcdef0123") == \
        [("endpoint", "https://h.example/cb?token=abcdefgh&sig=0123456789abcdef0123"), ("assign", "token=abcdefgh")]
    assert spans("https://h.example/Articles/2020/05/some-title-of-a-page") == []
    assert secret_scan.replaced("a " + url + " b", secret_scan.link(secret_scan.find_parts(("a " + url + " b").encode())), "#") == "a # b"


def test_redaction_keeps_rows_and_hides_spans(documents):
    out = secret_scan.redact(documents)
    assert out.schema.simpleString() == documents.schema.simpleString() and out.count() == documents.count()
    before = {r.doc_id: r for r in documents.collect()}
    for r in out.collect():
        spans = brute.base_spans(before[r.doc_id].text)
        assert brute.base_spans(r.text) == [] and ("[SECRET]" in (r.text or "")) == bool(spans)
        if not spans:
            assert r == before[r.doc_id]
    assert secret_scan.redact(documents.limit(0)).count() == 0
    assert secret_scan.replaced("abcdefgh", [("a", 1, 3), ("b", 2, 4), ("c", 6, 7)], "#") == "a#ef#h"


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_token_counts_equal_the_library(spark, documents, texts, name):
    path = public_tokenizers.path(name)
    library = Tokenizer.from_file(path)
    want = []
    for i, t in texts:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 2048))
    assert brute.rows(token_counts(documents, path)) == sorted(want, key=repr)
    assert token_counts(documents.limit(0), path).count() == 0


def test_token_counts_by_sentencepiece(documents, texts):
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    got = {(r.doc_id, r.n_bytes): r.n_tokens for r in token_counts(documents, path).collect()}
    assert got == {(i, len((t or "").encode())): len(library.encode(t or "")) for i, t in texts}


def test_pieces_of_random_texts():
    import random
    random.seed(3)
    parts = [" ", "  ", "\n", "\n\n", "\t", " ", " ", "\x1c", "\x85", "a", "The", "é", "é", "́", "'s", "12", "²", ".", "..", "中", "<|endoftext|>", "<|", "ſ", "Σ", "👍"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 20))) for _ in range(8_000)]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        library = Tokenizer.from_file(public_tokenizers.path(name))
        want = [len(e) for e in library.encode_batch(texts, add_special_tokens=False)]
        assert Pieces(public_tokenizers.path(name), True).lengths([t.encode() for t in texts]) == want


def test_ranks_give_the_tokenizers_ids():
    import random

    import numpy as np
    random.seed(4)
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, pieces = Tokenizer.from_file(path), Pieces(path, False, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    parts = [" ", "  ", "\n", "\n\n", "\t", "\u00a0", "\x1c", "\x85", "a", "The", "é", "'s", "12", "²", ".", "..", "中", "<|endoftext|>", "<|", "ſ", "👍"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 20))) for _ in range(8_000)]
    texts += [f"a{chr(c)}b {chr(c)} 1{chr(c)}{chr(c)}\n{chr(c)}.  {chr(c)}" for c in range(0x32000) if not 0xD800 <= c < 0xE000]
    texts += ["x" * 30_000, " " * 5_000 + "a", "\n" * 3_000]
    for i in range(0, len(texts), 10_000):
        some = texts[i:i + 10_000]
        want = [e.ids for e in library.encode_batch(some, add_special_tokens=False)]
        assert [np.frombuffer(x, "<u4").tolist() for x in pieces.ids([t.encode() for t in some])] == want


def test_chats_read_back(spark):
    data = [(1, 0, "system", "a&lt;[x]"), (1, 1, "user", None), (1, 2, "assistant", "</s>&amp;&"), (2, None, None, "x"), (2, 1, "to]ol", "[ROLE:a]"),
            (2, 1, "to]ol", "[ROLE:a]"), (None, 0, "user", "<<SYS>>"), (3, 0, "assistant", "x" * 200_000 + "["), (4, 0, "user", "q"), (4, 1, "assistant", "")]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS turns", "2 AS segments")
    done = chat.format_chats(df)
    got = {r.conv_id: r for r in done.withColumn("back", chat.read_turns(F.col("formatted"))).collect()}
    for c in {r[0] for r in data}:
        turns = sorted([(t is not None, t or 0, r or "", x or "") for i, t, r, x in data if i == c])
        assert [(t.role, t.text) for t in got[c].back] == [(r, x) for _, _, r, x in turns]
        assert got[c].formatted == "".join(s.text for s in got[c].segments)
    assert [got[c].valid for c in (1, 2, None, 3, 4)] == [True, False, True, False, True]
    digest = {r.conv_id: r for r in chat.chat_digests(done).collect()}
    assert digest[1].loss_chars == 10 and digest[1].loss_sha256 == hashlib.sha256("</s>&amp;&".encode()).hexdigest()
    assert digest[2].loss_chars == 0 and digest[3].loss_chars == 200_001
    assert chat.chat_digests(chat.format_chats(df.limit(0))).count() == 0


def test_quality_held_out_and_odd_texts(spark, documents):
    import __spark_entry__ as E
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet").select("doc_id", "quality")
    scored = E.queries()["op10_quality"](spark, SF_CHECK)
    rows = scored.join(labels, "doc_id").filter("held_out").collect()
    right = sum(r.predicted == r.quality for r in rows) / len(rows)
    assert right > 0.9, right
    for r in scored.limit(50).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    some = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    out = quality.quality_scores(documents, some.unionByName(spark.createDataFrame([(None, 1, 0), (1, None, 0), (2, 7, 0)], some.schema)))
    assert out.count() == documents.count() and out.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert {r.score for r in quality.quality_scores(documents, some.limit(0)).collect()} == {1.0}
    assert quality.quality_scores(documents.limit(0), some).count() == 0


def test_quality_blocks_do_not_change_scores():
    import numpy as np
    net = quality.train([b"good words here " * 9, b"$$$ ### &&& " * 200, b"fine text " * 30, b"%%% ***"], [1, 0, 1, 0])
    texts = [b"", b"x", b"good words " * 500, b"$$$ " * 4000]
    whole = quality.score(net, texts, net.pair_tables())
    one = [quality.score(net, [t], net.pair_tables(), block=3)[0] for t in texts]
    assert np.allclose(whole, one, atol=1e-5)


def test_quality_equals_a_plain_convolution():
    """Filter by filter, offset by offset; a text that is junk in its middle only, at an even and an odd offset."""
    import numpy as np
    net = quality.train([b"good words here " * 9, b"$$$ ### &&& " * 200, b"fine text " * 30, b"%%% ***"], [1, 0, 1, 0])

    def plain(raw):
        logits = []
        for start in range(0, max(1, len(raw) - quality.CHUNK + quality.STEP), quality.STEP):
            chunk = raw[start:start + quality.CHUNK].ljust(quality.CHUNK, b"\0")
            best = [max(sum(float(net.tables[j, chunk[at + j], f]) for j in range(quality.WIDTH)) for at in range(quality.CHUNK - quality.WIDTH + 1))
                    for f in range(quality.FILTERS)]
            pooled = [max(b + float(c), 0.0) for b, c in zip(best, net.bias)]
            boxes = [0.0] * len(quality.BOXES)
            for lag in quality.LAGS:
                same = [at >= lag and chunk[at] != 0 and chunk[at] == chunk[at - lag] for at in range(quality.CHUNK)]
                for k, width in enumerate(quality.BOXES):
                    boxes[k] = max(boxes[k], max(sum(same[a:a + width]) for a in range(0, quality.CHUNK - width + 1, 8)) / width)
            fill = sum(c != 0 for c in chunk) / quality.CHUNK
            extra = [max(b - 0.5, 0) * 2 for b in boxes] + [fill, float(fill < 0.05), float(fill < 0.2)]
            logits.append(sum(x * float(w) for x, w in zip(pooled + extra, net.out)))
        z = float(net.mix[0]) + float(net.mix[1]) * sum(logits) / len(logits) + float(net.mix[2]) * min(logits)
        return 1 / (1 + np.exp(-z))

    texts = [b"", b"x", b"good words " * 40, b"good words " * 60 + b"$$$ ### " * 20 + b"fine text " * 50, b"!" + b"good words " * 60 + b"$$$ ### " * 20 + b"fine text " * 50]
    assert np.allclose(quality.score(net, texts, net.pair_tables()), [plain(t) for t in texts], atol=1e-4)
