"""Each training-data operator against brute force, and on odd input."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from conftest import SMALL_SF
from pyspark.sql import functions as F

from plexus.llm import (
    decontamination,
    language_id,
    mixcoder,
    packing,
    quality_rules,
    queries,
    secret_scan,
    simhash,
    token_counts,
    token_files,
    tokens,
    toxicity,
    url_filter,
)
from plexus.llm.common import table
from plexus.llm.components import components
from plexus.session import scratch_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
# clashing names: of internal columns, outputs and other tables' columns
DOCS = ("doc_id long, text string, lang string, source string, n_chars long, m string, stratum string, row string, "
        "`_id` string, score string, `a.b` string, fp string, label string")
LONG = "word soup of letters. " * 30_000
ODD = [
    (1, None, None, None, None), (2, "", "en", "s", 0), (3, " \t\n ", "en", "s", 4), (4, "x", None, None, 1),
    (5, "the same text over and over again, with password=b7db7aa4a5fcc78305 in it", "en", "s", 1),
    (5, "the same text over and over again, with password=b7db7aa4a5fcc78305 in it", "en", "s", 1),
    (6, "the same text over and over again, with password=b7db7aa4a5fcc78305 in it", "de", "t", 1),
    (None, "no id here", "en", "s", 1), (7, LONG, "en", "s", 1), (8, "日本語 ÄÖ <|endoftext|> \x00 🙂", "ja", "s", 1),
    (9, "card 4994226020900891 and +1 (771) 555-1655", "en", "s", 1)]


@pytest.fixture(scope="module")
def odd(spark):
    table(spark, SMALL_SF, "documents")
    return spark.createDataFrame([(*r, "m", "s", "r", "i", "c", "d", "f", "l") for r in ODD], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SMALL_SF, "documents")


def labels_of(spark, rows=((1, 1, 0), (2, None, None), (None, 1, 1), (5, 0, 1), (5, 1, 0), (99, 1, 1))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


# ---------------------------------------------------------------- 1 URL filters

URLS = [None, "", "no scheme", "http://", "http://A.Net/x?y", "https://example.net/en/1", "https://www.EXAMPLE.net/en/1#a",
        "http://example.com/de/", "http://xexample.com/de/", "http://a.example.com/de?x", "http://x.org/fr/1",
        "http://org/fr/1", "http://net", "http://net/", "http://x.com/ä?q://b", "http://x.com://y/", "ftp://a.b/c#://d"]


def url_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def url_rule(host, path):
    fits = [r for r in queries.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


def test_url_rules_on_odd_urls(spark):
    pages = spark.createDataFrame([(i % 5, u, "h") for i, u in enumerate(URLS + URLS)], "page_id long, url string, host string")
    got = url_filter.filter_urls(pages, queries.URL_RULES).collect()
    want = []
    for i, u in enumerate(URLS + URLS):
        h, p = url_parts(u)
        r = url_rule(h, p)
        want.append((i % 5, h, p, r and r.text, r and r.verdict))
    assert sorted(map(str, want)) == sorted(str((x.page_id, x.host, x.path, x.rule, x.verdict if x.rule else None)) for x in got)
    assert all(x.verdict in ("allow", "block") for x in got)
    assert all(x.verdict == "block" for x in got if x.host == "" and x.score is None)
    assert url_filter.filter_urls(pages.limit(0), queries.URL_RULES).count() == 0


def test_url_scores_match_plain_models(spark):
    pages = table(spark, SMALL_SF, "pages")
    got = url_filter.filter_urls(pages, queries.URL_RULES).collect()
    k = url_filter.ORDER
    counts = {c: defaultdict(lambda: defaultdict(int)) for c in ("allow", "block")}

    def text(h, p):
        s = re.sub("[^a-z0./_-]", "~", re.sub("[0-9]", "0", "".join(c.lower() if "A" <= c <= "Z" else c for c in h + p)))
        return "^" * k + s + "$"

    for r in pages.collect():
        h, p = url_parts(r.url)
        rule = url_rule(h, p)
        if rule and int(hashlib.md5(h.encode()).hexdigest()[:8], 16) % url_filter.FOLDS:
            s = text(h, p)
            for i in range(k, len(s)):
                for o in range(k + 1):
                    counts[rule.verdict][s[i - o:i]][s[i]] += 1

    def prob(c, ctx, ch):
        q = 1 / url_filter.ALPHABET if not ctx else prob(c, ctx[1:], ch)
        seen = counts[c].get(ctx)
        if not seen:
            return q
        n, t = sum(seen.values()), len(seen)
        return (seen.get(ch, 0) + t * q) / (n + t)

    for x in got[:60]:
        s = text(x.host, x.path)
        llr = [np.log(prob("allow", s[i - k:i], s[i])) - np.log(prob("block", s[i - k:i], s[i])) for i in range(k, len(s))]
        assert x.score == pytest.approx(np.mean(llr), abs=1e-9)


# ---------------------------------------------------------------- 2, 4 fields

def test_forward_backward_matches_enumeration():
    from itertools import product

    from plexus.llm import crf
    rng = np.random.default_rng(3)
    lengths = np.array([3, 1, 4])
    seq = crf.Sequences(np.arange(8), np.zeros(8, np.int64), np.array([0, 3, 4]), lengths)
    scores, move = rng.normal(size=(8, 3)).astype(np.float32), rng.normal(size=(3, 3))
    pairs = np.zeros((3, 3))
    got = crf.CRF(np.zeros((1, 3)), move).marginals(scores, seq, pairs)
    want, both = np.zeros((8, 3)), np.zeros((3, 3))
    for a, n in zip(seq.starts, lengths, strict=True):
        paths = list(product(range(3), repeat=int(n)))
        w = np.array([np.exp(sum(scores[a + i, y] for i, y in enumerate(p)) + sum(move[x, y] for x, y in zip(p, p[1:], strict=False)))
                      for p in paths])
        for p, v in zip(paths, w / w.sum(), strict=True):
            for i, y in enumerate(p):
                want[a + i, y] += v
            for x, y in zip(p, p[1:], strict=False):
                both[x, y] += v
    assert np.allclose(got, want, atol=1e-5) and np.allclose(pairs, both, atol=1e-4)


def test_features_of_a_word_do_not_depend_on_its_neighbours():
    from plexus.llm import crf
    f = crf.Features(prefixes=(1, 3), suffixes=(2,), grams=(2, 3), lengths=True, lexicon={"abc": 1})
    words = ["abc", "Abc", "x", "straße", "日本", "abcd" * 500, "abc"]
    at, owner = f(words)
    own = [sorted(at[owner == i].tolist()) for i in range(len(words))]
    assert own[0] == own[1] == own[6] and own[0] != own[2]
    for i, w in enumerate(words):
        assert sorted(f([w])[0].tolist()) == own[i]
    assert len(f([])[0]) == 0


def test_toxicity_finds_words_and_offsets(spark, odd, none):
    rng = np.random.default_rng(1)
    bad, plain = ["vextoru", "vextoran", "grumlish"], [f"w{i}" for i in range(60)]
    texts, y = [], []
    for i in range(200):
        w = rng.choice(plain, 20).tolist()
        if i % 2:
            w[5] = bad[i % 3]
        texts.append(" ".join(w))
        y.append(i % 2)
    model = toxicity.fit(texts, y, 0.1)
    df = spark.createDataFrame([(1, "w1 w2 vextoren w3. w4"), (2, "w1 w2 w3"), (3, None), (4, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score(df, model).collect()}
    assert got[1].score > 0.9 and [(s.start, s.end) for s in got[1].spans] == [(6, 14)]
    assert all(got[i].score < 0.1 and not got[i].spans for i in (2, 3, 4))
    assert toxicity.score(odd, model).count() == len(ODD)
    assert toxicity.score(none, model).count() == 0
    empty = toxicity.train(odd, labels_of(spark, []))
    assert {r.score for r in toxicity.score(odd, empty).collect()} == {0.0}


def test_copies_of_a_document_are_no_evidence():
    rng = np.random.default_rng(2)
    plain = [f"w{i}" for i in range(300)]
    copy = " ".join(rng.choice(plain, 40)) + " rareword oddword " + " ".join(rng.choice(plain, 40))
    texts = [copy + f" tail{i}" for i in range(50)] + [" ".join(rng.choice(plain, 60)) for _ in range(150)]
    y = [1] * 50 + [0] * 150
    groups = toxicity.copy_groups(texts)
    assert len(set(groups[:50])) == 1 and len(set(groups[50:])) == 150
    words_ = [set(t.split()) for t in texts]
    assert not toxicity._toxic_marks(words_, y, groups)
    assert "wrareword" in toxicity._toxic_marks(words_, y, list(range(200)))
    assert toxicity.copy_groups(["", "", "a b"])[2] == 2


def test_shared_passages_neither_hide_nor_make_evidence():
    rng = np.random.default_rng(3)
    plain = [f"w{i}" for i in range(300)]
    footer = " ".join(f"foot{i}" for i in range(55))

    def text(i, bad, end):
        own = [*rng.choice(plain, 80)]
        own[7:7] = bad
        own[50:50] = bad
        return " ".join([*own, *end])
    texts = [text(i, ["vileword"], [footer, "only toxic texts end thus"]) for i in range(60)] + [text(i, [], [footer]) for i in range(140)]
    y = [1] * 60 + [0] * 140
    assert len(set(toxicity.copy_groups(texts))) == 200
    index = toxicity.crf.Words()
    seq = toxicity.crf.read(texts, toxicity.PATTERN, index)
    found = toxicity.found_marks(texts, y, seq, index.new)
    assert "wvileword" in found and not found & {"wfoot3", "wonly", "wtoxic", "wtexts"}


def test_toxicity_held_out(spark):
    got = queries.toxic(spark, "/root/testdata/sf0.01").collect()
    lab = {r.doc_id: r.toxic for r in table(spark, "/root/testdata/sf0.01", "labels").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = np.array([(lab[r.doc_id], r.predicted) for r in got if r.held_out and lab.get(r.doc_id) is not None])
    toxic, called = held[:, 0] == 1, held[:, 1] == 1
    assert toxic.sum() >= 10 and called.sum() >= 10  # a constant answer has no recall or no precision
    assert (toxic & called).sum() / toxic.sum() >= 0.7 and (toxic & called).sum() / called.sum() >= 0.75


def test_language_held_out(spark, odd, none):
    d = table(spark, "/root/testdata/sf0.01", "documents")
    got = {r.doc_id: r for r in queries.languages(spark, "/root/testdata/sf0.01").collect()}
    true = {r.doc_id: r.lang for r in d.collect()}
    held = [i for i in got if got[i].held_out]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in got)
    assert np.mean([got[i].lang_pred == true[i] for i in held]) > 0.97
    model = language_id.train(d, lambda i: ~language_id.held_out(i))
    out = [(r.doc_id, r.lang_pred, r.score) for r in language_id.label(odd, model).collect()]
    assert len(out) == len(ODD) and {(i, p, s) for i, p, s in out if i in (1, 2, 3)} == {(i, "und", 0.0) for i in (1, 2, 3)}
    assert all(0 <= s <= 1 for _, _, s in out)
    assert language_id.label(none, model).count() == 0
    signs = spark.createDataFrame([(1, "½ ²①"), (2, "Ⅷ ³ ٣ 12_"), (3, "½a"), (4, "一二")], "doc_id long, text string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in language_id.label(signs, model).collect()}
    assert found[1] == found[2] == ("und", 0.0) and found[3][0] != "und" and found[4][0] != "und"
    assert {r.lang_pred for r in language_id.label(odd, language_id.train(none, lambda i: ~language_id.held_out(i))).collect()} == {"und"}
    en, fr = (next(r.text for r in d.collect() if r.lang == x and len(r.text) > 400)[:300] for x in ("en", "fr"))
    mixed = spark.createDataFrame([(1, en + " " + fr)], "doc_id long, text string")
    spans = language_id.label(mixed, model, spans=True).first().spans
    assert {s.lang for s in spans} >= {"en", "fr"} and spans[0].lang == "en" and spans[-1].lang == "fr"


# ---------------------------------------------------------------- 3, 5, 6 tokens

def plain_ids(texts):
    return [e.ids for e in tokens.encoder(TOKENIZER).tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_word_cache_gives_the_tokenizers_ids():
    enc = tokens.WordEncoder(TOKENIZER)
    texts = ["", " ", "a\n\nb", "Don't 12 <|endoftext|> x<|startoftext|>y", "ÀÉ́ ﬁ İstanbul ǅ", "a\tb\x0bc\x85d\xa0e f",
             "x.y, z", "ß ẞ", "\x1cq\x1c a\x1fb", "🙂 a🙂b", LONG]
    ids, n, *_ = enc.encode(texts)
    want = plain_ids(texts)
    assert n.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


@pytest.mark.parametrize("n", [0, 1, 4095, 4096, 4097, 9000])
def test_coder_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.where(rng.random(n) < 0.5, rng.integers(0, 50, n), rng.integers(0, 65536, n))
    payload, sizes, crcs = mixcoder.encode(ids)
    assert mixcoder.decode(payload, sizes, crcs, n).tolist() == ids.tolist()
    if n > 1:
        wrong = bytearray(payload)
        wrong[0] ^= 0x40
        with pytest.raises(ValueError):
            mixcoder.decode(bytes(wrong), sizes, crcs, n)


def test_coder_learns():
    ids = np.tile(np.arange(100, 400), 40)
    assert len(mixcoder.encode(ids)[0]) * 8 / len(ids) < 4
    with pytest.raises(ValueError):
        mixcoder.encode(np.array([70_000]))


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_round_trip(spark, docs, odd, none):
    for df in (docs, odd, none):
        path = scratch_path(spark, "test-ids")
        token_files.write_tokens(df, path, TOKENIZER, 1)
        got = token_files.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("c")).collect()
        rows = df.select("doc_id", "text").collect()
        want = sorted((r.doc_id or -1, len(i) + 1, crc([*i, 1])) for r, i in zip(rows, plain_ids([r.text for r in rows]), strict=True))
        assert sorted((r.doc_id or -1, r.n_tokens, r.c) for r in got) == want
        at = 0
        for r in sorted(got, key=lambda r: r.start):
            assert r.start == at
            at += r.n_tokens


def test_packing(spark, docs, odd, none):
    assert packing.pack(none, TOKENIZER, 2).count() == 0
    for df in (docs, odd):
        rows = df.select("doc_id", "text").collect()
        want = sorted((r.doc_id or -1, crc([*i, 2])) for r, i in zip(rows, plain_ids([r.text for r in rows]), strict=True))
        got = packing.pack(df, TOKENIZER, 2).collect()
        whole, by_doc, by_seq = [], defaultdict(list), defaultdict(list)
        for r in got:
            by_doc[r.doc_id].append(r)
            by_seq[r.sequence_id].append(r)
        for i, ps in by_doc.items():
            ps.sort(key=lambda r: (r.sequence_id, r.offset))
            buf = b""
            for p in ps:
                assert len(p.ids) == 4 * p.length and p.start == len(buf) // 4
                buf += bytes(p.ids)
                if len(buf) == 4 * p.doc_tokens:
                    whole.append((i or -1, zlib.crc32(buf)))
                    buf = b""
            assert not buf
        assert sorted(whole) == want
        for ps in by_seq.values():
            at = 0
            for p in sorted(ps, key=lambda r: r.offset):
                assert p.offset == at
                at += p.length
            assert at <= 4096


def test_cuts_are_the_best():
    rng = np.random.default_rng(5)
    for _ in range(30):
        pos = np.concatenate([[0], np.cumsum(rng.integers(1, 8, 12))])
        pen = np.concatenate([[0], rng.choice([0, 3, 9], 12)])
        width = 16

        def cost(cuts, pos=pos, pen=pen):
            at = dict(zip(pos.tolist(), pen.tolist(), strict=True))
            return sum(width - (b - a) + at[b] for a, b in zip(cuts, cuts[1:], strict=False))

        best = {0: 0}
        for j in range(1, len(pos)):
            best[j] = pen[j] + width - pos[j] + min(best[i] + pos[i] for i in range(j) if pos[j] - pos[i] <= width)
        cuts = packing.choose_cuts(pos, pen, width)
        assert cuts[-1] == pos[-1] and all(0 < b - a <= width for a, b in zip(cuts, cuts[1:], strict=False))
        assert cost(cuts) == best[len(pos) - 1]


def test_padding_is_small(spark):
    got = packing.pack(table(spark, "/root/testdata/sf0.1", "documents").where("doc_id < 3000"), TOKENIZER, 2).select(
        "sequence_id", "length").groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert sum(r.n for r in got) / (4096 * len(got)) > 0.97


def test_token_counts_match_the_library(spark, docs, odd, none):
    from tokenizers import Tokenizer, models, pre_tokenizers
    vocabulary = token_counts.sentencepiece_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    ref = Tokenizer(models.Unigram(list(vocabulary.pieces), unk_id=0, byte_fallback=False))
    ref.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always")
    for df in (docs, odd, none):
        rows = df.select("doc_id", "text").collect()
        want = sorted((r.doc_id or -1, len(ref.encode(r.text or "", add_special_tokens=False).ids)) for r in rows)
        assert sorted((r.doc_id or -1, r.n_tokens) for r in token_counts.count_tokens(df, vocabulary).collect()) == want


def test_token_count_ties():
    from tokenizers import Tokenizer, models
    pieces = (("<unk>", 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("abab", -4.0), ("ba", -2.0), ("aba", -3.0))
    counter = token_counts.Counter(token_counts.Vocabulary(pieces))
    ref = Tokenizer(models.Unigram(list(pieces), unk_id=0, byte_fallback=False))
    for n in range(1, 7):
        for k in range(3 ** n):
            w = "".join("abx"[k // 3 ** i % 3] for i in range(n))
            assert counter.count_word(w) == len(ref.encode(w).ids), w


# ---------------------------------------------------------------- 7 SimHash

def plain_fingerprint(text, k=4):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))


def plain_groups(values, radius):
    parent = {v: v for v in values}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= radius:
                parent[root(a)] = root(b)
    return {v: root(v) for v in values}


def test_simhash_matches_brute_force(spark, docs, odd, none):
    for df in (docs, odd, none):
        rows = df.select("doc_id", "text").collect()
        fp = [plain_fingerprint(r.text) for r in rows]
        root = plain_groups(sorted(set(fp)), 4)
        lead = {}
        for r, f in zip(rows, fp, strict=True):
            if r.doc_id is not None:
                lead[root[f]] = min(r.doc_id, lead.get(root[f], r.doc_id))
        want = sorted(str((r.doc_id, f"{f:016x}", lead.get(root[f]))) for r, f in zip(rows, fp, strict=True))
        assert sorted(str((r.doc_id, r.fingerprint, r.component_id)) for r in simhash.near_duplicates(df).collect()) == want
        kept = simhash.keep_one(df)
        assert kept.columns == df.columns and kept.count() == len(set(root.values()))


def test_unrelated_texts_that_share_an_id_are_kept(spark):
    texts = ["the quick brown fox jumps over the lazy dog", "colourless green ideas sleep furiously all night long",
             "it was a bright cold day in april and clocks struck", "call me ishmael some years ago never mind how long"]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (8, texts[3])]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(str, kept)) == sorted(f"Row(doc_id={i}, text={t!r})" for i, t in zip((None, None, 7, 7), texts, strict=True))


@pytest.mark.parametrize("shard", [20_000, 40])
def test_shards_lose_no_link(spark, shard, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", shard)
    rng = np.random.default_rng(9)
    dense = [int(x) & 0x0F0F for x in rng.integers(0, 1 << 16, 300)]
    wide = [int(x) for x in rng.integers(0, 1 << 62, 50)]
    near = [v ^ (1 << int(b)) ^ (1 << int(c)) for v in wide for b, c in rng.integers(0, 64, (2, 2))]
    values = sorted({v - (1 << 64) if v >> 63 else v for v in dense + wide + near})
    got = components(simhash.near_links(spark.createDataFrame([(v,) for v in values], "fp long"), 4)).collect()
    unsigned = {v & (1 << 64) - 1: v for v in values}
    want = plain_groups(sorted(unsigned), 4)
    parts, mine = defaultdict(set), defaultdict(set)
    for v, r in want.items():
        parts[r].add(unsigned[v])
    for r in got:
        mine[r.root].add(r.node)
    assert {frozenset(p) for p in parts.values() if len(p) > 1} == {frozenset(p) for p in mine.values()}
    assert simhash.shard_masks(10 ** 12, 4) != simhash.shard_masks(1000, 4)


def test_components_of_a_long_chain(spark):
    n = 300
    edges = spark.createDataFrame([((i * 7919) % n, ((i + 1) * 7919) % n) for i in range(n - 1)] + [(1000, 1001), (5, 5)], "u long, v long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(n)}, 1000: 1000, 1001: 1000}
    assert components(edges.limit(0)).count() == 0


def test_bk_tree_search():
    rng = np.random.default_rng(4)
    values = [int(x) for x in rng.integers(0, 1 << 12, 300)]
    tree = simhash.BKTree(2)
    for v in dict.fromkeys(values):
        tree.add(v)
    for q in values[:40]:
        assert sorted(tree.within(q)) == sorted(v for v in set(values) if (v ^ q).bit_count() <= 2)


# ---------------------------------------------------------------- 8 decontamination

def test_alignment_scores():
    rng = np.random.default_rng(2)
    pairs = [(rng.integers(0, 6, rng.integers(1, 30)), rng.integers(1, 6, rng.integers(1, 12))) for _ in range(80)]

    def plain(a, b):
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                s = 2 if a[i] == b[j] and a[i] > 0 else -1
                h[i + 1, j + 1] = max(0, h[i, j] + s, h[i, j + 1] - 1, h[i + 1, j] - 1)
        return h.max()
    got = decontamination.best_scores(pairs)
    for (a, b), s in zip(pairs, got.tolist(), strict=True):
        assert s == plain(a, b) == decontamination.align([x or -1 for x in a.tolist()], b.tolist())[0]


def test_planted_copies_are_found(spark, docs, odd, none):
    items = table(spark, SMALL_SF, "benchmark")
    some = [r for r in items.orderBy("item_id").collect() if len(r.text.split()) > 20][:20]
    filler = [r.text for r in docs.where("lang = 'de'").limit(20).collect()]
    rng = np.random.default_rng(6)
    rows = []
    for k, r in enumerate(some):
        w = r.text.split()
        if k % 2:  # an edited copy: one word in eight replaced
            for i in rng.choice(len(w), len(w) // 8, replace=False):
                w[i] = "xxxx"
        rows.append((k, filler[k][:500] + " " + " ".join(w).upper() + " " + filler[k][:300]))
    rows += [(100 + k, f) for k, f in enumerate(filler)] + [(200, None), (201, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = decontamination.contaminated(df, items).collect()
    assert {(r.doc_id, r.item_id) for r in got if r.doc_id < 100} == {(k, r.item_id) for k, r in enumerate(some)}
    clean = {r.doc_id for r in got if r.doc_id >= 100}
    assert not [i for i in clean if not any(b.text in filler[i - 100] for b in items.collect())]
    text = dict(rows)
    for r in got:
        if r.doc_id < 100 and r.doc_id % 2 == 0:
            span = text[r.doc_id][r.start:r.end].lower()
            assert r.score == 1.0 and re.findall(r"\w+", span) == re.findall(r"\w+", some[r.doc_id].text.lower())
    kept = decontamination.keep_clean(df, items)
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - {r.doc_id for r in got}
    strange = spark.createDataFrame([(1, None), (2, ""), (3, "x"), (3, "x"), (None, "over and over again")], "item_id long, text string")
    assert {r.item_id for r in decontamination.contaminated(odd, strange).collect()} == {3, None}
    assert decontamination.contaminated(none, strange).count() == 0
    assert decontamination.contaminated(odd, strange.limit(0)).count() == 0
    assert decontamination.keep_clean(odd, strange.limit(0)).count() == len(ODD)


def test_blocks_of_items_give_the_same(spark, docs, monkeypatch):
    items = table(spark, SMALL_SF, "benchmark")
    want = sorted(map(tuple, decontamination.contaminated(docs, items).collect()))
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 4000)
    assert want and sorted(map(tuple, decontamination.contaminated(docs, items).collect())) == want


# ---------------------------------------------------------------- 9 secrets

def test_secret_candidates_and_redaction(spark, odd, none):
    for df in (table(spark, "/root/testdata/sf0.01", "documents"), odd):
        rows = df.collect()
        pat = re.compile(secret_scan.RUN)
        want = sorted((r.doc_id or -1, m.start(), m.end()) for r in rows for m in pat.finditer(r.text or ""))
        got = secret_scan.scan(df).collect()
        assert sorted((r.doc_id or -1, r.start, r.end) for r in got) == want
        assert all(r.secret == bool(r.label) for r in got if r.label is not None)
        by = defaultdict(set)
        for r in got:
            if r.secret:
                by[r.doc_id].add((r.start, r.end))
        def mask(r, by=by):
            t = r.text
            for a, b in sorted(by.get(r.doc_id, ()), reverse=True):
                t = t[:a] + secret_scan.MASK + t[b:]
            return t
        out = secret_scan.redact(df)
        assert out.columns == df.columns
        assert sorted(str((r.doc_id, r.text)) for r in out.collect()) == sorted(str((r.doc_id, mask(r))) for r in rows)
    assert secret_scan.scan(none).count() == 0 and secret_scan.redact(none).count() == 0


JWT = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxIn0.abcDEFghiJKLmno"
PEM = "-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4\n\nabcd\nEFgh\n-----END RSA PRIVATE KEY-----"
SHAPES = [  # text before, secret, text after
    ('password = "', "correcthorsebattery", '" x'), ("a password=", "P@ss!w0rd#Xy9", ", b"), ("pwd: ", "hunter2", " and"),
    ('{"db_password":"', r"a b\"c!", '","u":1}'), ("db2_password=", "xyz.abc", ""), ("Authorization: Bearer ", "q.w~e", ""),
    ("\x01\x02🙂 token := '", "a\x01b 🙂", "'"), ('password="', "x" * 100_000, '" end'), ('secret: ', r"\"a" * 5000, ""),
    ("jwt ", JWT, " end"), ("k ", PEM, " z"), ("x ", "AbCdEfGhIjKlMnOpQr", "==")]


def test_secrets_of_other_shapes(spark):
    rows = [(-i - 1, a + v + b, "s") for i, (a, v, b) in enumerate(SHAPES)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {(r.doc_id, r.start, r.end) for r in secret_scan.scan(df).collect()}
    assert {(-i - 1, len(a), len(a) + len(v)) for i, (a, v, _) in enumerate(SHAPES)} <= got
    out = {r.doc_id: r.text for r in secret_scan.redact(df).collect()}
    assert out[-10] == "jwt [SECRET] end" and out[-11] == "k [SECRET] z" and "correct" not in out[-1]
    plain = [("author: Smith",), ("password:",), ("see passages: https://a.b/c",), ("getElementById",), (None,)]
    assert not spark.createDataFrame(plain, "text string").where(secret_scan.with_candidates(F.col("text"))).count()


@pytest.mark.parametrize("gap", [" ", "  ", "\t\t ", "\n    ", "\r\n\t"])
def test_neighbouring_words_of_a_secret(spark, gap):
    value = "24be64439e3e49cf46b2d7c9"
    for q in ("", '"'):
        text = f"  my token{gap}={gap}{q}{value}{q}{gap}12 next"
        df = spark.createDataFrame([(0, 1, text, "s")], "row long, doc_id long, text string, source string")
        [r] = secret_scan.features(secret_scan.candidates(df).withColumn("covered", F.lit(0.0))).collect()
        assert (r.prev, r.left, r.after) == ("token =", q, "12") and text[r.start:r.end] == value
        assert (r.key_word, r.assigned, r.quoted, r.next_number) == (1, 1, bool(q), 1)


def test_dictionary_takes_whole_words_of_distinct_texts(spark, monkeypatch):
    texts = ["token = a1b2c3d4e5f67LmQzRtWxYv copied"] * 9  # copies of one text
    texts += [f'plain words {i} here, card 4994226020900891{i} pass="inside!value" 77kQzRt7wXyvb' for i in range(6)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "row long, text string")
    def got():
        return {r.dict_word for r in secret_scan.dictionary(df).collect()}
    assert got() == {"plain", "words", "here", "card"}
    monkeypatch.setattr(secret_scan, "DICTIONARY_SHARE", 0.9)  # of 7 distinct texts: 7
    assert got() == set()


# ---------------------------------------------------------------- 10 quality

def plain_measures(text):
    t = text or ""
    w = words(t)
    win = defaultdict(list)
    for i in range(len(w) - 7):
        win[tuple(w[i:i + 8])].append(i)
    hit = {i + k for at in win.values() if len(at) > 1 for i in at for k in range(8)}
    lines = [x for x in t.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit))


def test_quality_measures(spark, docs, odd, none):
    extra = spark.createDataFrame([(1, "a b c d e f g h " * 5, "en", "s", 1), (2, "x y\nx y\n \nx y\n\n", "en", "s", 1),
                                   (3, "a " * 40, "en", "s", 1), (4, "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8 1 2", "en", "s", 1)],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    for df in (docs, odd, extra, none):
        rows = df.collect()
        want = []
        for r in rows:
            m = plain_measures(r.text)
            want.append(str((r.doc_id, *m, m[0] < 20 or 100 * m[4] > 30 * m[0])))
        got = quality_rules.judge(df, labels_of(spark)).collect()
        assert sorted(str((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed))
                      for r in got) == sorted(want)
        assert all(not r.kept for r in got if r.base_failed)
        kept = quality_rules.keep_good(df, labels_of(spark))
        assert kept.columns == df.columns and kept.count() == sum(r.kept for r in got)


def test_binomial_tail_is_exact(spark):
    from fractions import Fraction
    from math import comb
    cases = [(0, 1), (0, 500), (3, 800), (7, 1000), (20, 3000), (9, 1000)]
    p = 0.01
    df = spark.createDataFrame(cases, "k int, n int").select("k", "n", quality_rules.binomial_cdf(F.col("k"), F.col("n"), p).alias("c"))
    for r in df.collect():
        q = Fraction(p)
        exact = float(sum(comb(r.n, i) * q ** i * (1 - q) ** (r.n - i) for i in range(r.k + 1)))
        assert r.c == pytest.approx(exact if r.k < r.n * p else 1.0, rel=1e-9)


def test_thresholds_keep_good_documents(spark):
    rng = np.random.default_rng(8)
    rows, labels = [], []
    for i in range(4000):
        good = i % 4 > 0
        w = rng.choice([f"w{k}" for k in range(500)], 40).tolist()
        if not good and i % 8 == 0:
            w = [x + "$$$" for x in w]
        if good and i % 1999 == 1:
            w[0] += "$"
        rows.append((i, " ".join(w), "en" if i % 2 else None))
        labels.append((i, int(good), 0))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = quality_rules.judge(df, labels_of(spark, labels)).collect()
    assert sum(r.kept for r in got if r.doc_id % 4) >= 0.95 * 3000
    assert sum(not r.kept for r in got if r.doc_id % 8 == 0) == 500
    few = quality_rules.judge(df, labels_of(spark, labels[:40])).collect()
    assert all(r.kept for r in few if not r.base_failed)


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_its_sql(spark, name, sf):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf{sf}/{t}.parquet')")
    res = con.sql(queries.ORACLE_SQL[name])
    df = queries.QUERIES[name](spark, f"/root/testdata/sf{sf}")
    assert sorted(df.columns) == sorted(res.columns)
    want = sorted(str(tuple(r)) for r in res.select(*df.columns).fetchall())
    assert sorted(str(tuple(r)) for r in df.collect()) == want


# ---------------------------------------------------------------- hot keys

def test_language_sample_has_every_language(spark, monkeypatch):
    """A language with long texts only, and more languages than the sample has room for, are learned."""
    monkeypatch.setattr(language_id, "SAMPLE", 3)
    monkeypatch.setattr(language_id, "MAX_SAMPLE", 6)
    monkeypatch.setattr(language_id, "SAMPLE_CHARS", 200)
    seen = {}
    monkeypatch.setattr(language_id, "fit", lambda texts, langs, **k: seen.update(texts=texts, langs=langs))
    rows = [(i, "kurz und gut", "de") for i in range(50)] + [(100 + i, "une tres longue histoire " * 40, "fr") for i in range(50)]
    rows += [(200 + i, f"word {i}", f"l{i}") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    language_id.train(df, lambda i: F.lit(True))
    assert set(seen["langs"]) == {"de", "fr", *(f"l{i}" for i in range(9))}
    assert len(seen["langs"]) <= 11 and max(map(len, seen["texts"])) <= 200


def test_one_doc_id_in_all_rows(spark, request):
    """Equal ids are cut into several tasks by their texts; nothing is lost, and a retry keeps the order."""
    texts = [f"text number {i} of many " * 40 for i in range(400)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    request.addfinalizer(lambda: spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    for same in (7, None):
        df = spark.createDataFrame([(same, t) for t in texts], "doc_id long, text string").repartition(6)
        path = scratch_path(spark, "equal-ids")
        token_files.write_tokens(df, path, TOKENIZER, 1)
        assert spark.read.parquet(path).select("part").distinct().count() > 1
        got = [token_files.read_tokens(spark, path).select("start", "n_tokens", F.crc32("ids").alias("c")).collect() for _ in range(2)]
        assert sorted(got[0]) == sorted(got[1]) and len(got[0]) == 400
        pieces = packing.pack(df, TOKENIZER, 2)
        assert pieces.select(F.spark_partition_id()).distinct().count() > 1
        assert pieces.agg(F.sum("length")).first()[0] == sum(r.n_tokens for r in got[0])


def test_vocabularies_over_16_bits_are_refused(monkeypatch):
    class Large:
        @staticmethod
        def from_file(path):
            class T:
                def get_vocab_size(self):
                    return 70_000
            return T()
    import tokenizers
    monkeypatch.setattr(tokenizers, "Tokenizer", Large)
    with pytest.raises(ValueError, match="16 bits"):
        tokens.WordEncoder("x")


def test_copies_are_one_trial(spark):
    """A text that stands a thousand times in the holdout counts once."""
    good = " ".join(f"w{i}" for i in range(60))
    texts = [good + f" {i}" for i in range(40)] + [good.upper() + "!" * 9] * 1000
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(len(texts))], "doc_id long, quality int")
    cuts = quality_rules.calibrate(quality_rules.rate_documents(docs), labels).collect()
    once = quality_rules.calibrate(quality_rules.rate_documents(docs.where("doc_id <= 40")), labels).collect()
    assert sorted(map(str, cuts)) == sorted(map(str, once))


def test_components_of_a_hub(spark):
    """A root with a third of all links, and chains: broadcasts off and small partitions, so the split path runs."""
    edges = [(0, i) for i in range(1, 400)] + [(1000 + i, 1001 + i) for i in range(700)] + [(5000 + 2 * i, 5001 + 2 * i) for i in range(100)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1k")
        got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = {i: 0 for i in range(400)} | {1000 + i: 1000 for i in range(701)} | {5000 + i: 5000 + i // 2 * 2 for i in range(200)}
    assert got == want
