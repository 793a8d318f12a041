"""Operators on texts against brute force, and their edge cases."""

import math
import random
import re

import pytest
import public_tokenizers
from tokenizers import Tokenizer

from nestweave.llm import quality
from nestweave.llm import sentencepiece_codec as codec
from nestweave.llm.decontaminate import benchmark_matches
from nestweave.llm.near_duplicates import least_matches, near_duplicates
from nestweave.llm.pii import KINDS, find_personal_data, joined, mask_personal_data
from nestweave.llm.token_counts import count_tokens

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [
    (9001, None),
    (9002, ""),
    (9003, "  \n\t "),
    (9004, "one"),
    (9005, "é😀 中文 x\u00a0y\u3000z <|endoftext|> a▁b"),
    (9006, "word " * 30_000),
    (9006, "word " * 30_000),
    (None, "no id here at all"),
    (9007, "a" * 5000),
]


@pytest.fixture(scope="module")
def docs(spark):
    read = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    return read.unionByName(spark.createDataFrame(ODD, "doc_id long, text string")).cache()


def words(text):
    return WORD.findall(text or "")


def test_personal_data(docs):
    base = tuple(k for k in KINDS if k.base)
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def luhn(digits):
        return sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits))) % 10 == 0

    def valid(kind, match):
        digits = re.sub("[^0-9]", "", match)
        if kind == "ip":
            return all(int(p) <= 255 for p in match.split("."))
        if kind == "card":
            return 13 <= len(digits) <= 19 and luhn(digits)
        return kind == "email" or 9 <= len(digits) <= 15

    for row in find_personal_data(docs).select("text", joined(base).alias("spans")).collect():
        expected = [
            f"{kind}:{m.start()}:{m.end()}"
            for kind, pattern in patterns.items()
            for m in re.finditer(pattern, row.text or "")
            if valid(kind, m[0])
        ]
        assert row.spans == ",".join(expected)


def test_checked_numbers_and_masks(spark):
    texts = [
        "IBAN DE89 3704 0044 0532 0130 00 and DE89 3704 0044 0532 0130 01",
        "social security 123-45-6789, part 123-45-6789",
        "x@y.z a@b.c.@d.e 1.2.3.4.5.6.7.8 256.1.1.1",
        None,
        "",
        "nothing",
    ]
    frame = spark.createDataFrame([(k, t, "kept") for k, t in enumerate(texts)], "doc_id long, text string, pii string")
    found = [r[0] for r in find_personal_data(frame).orderBy("doc_id").select(joined(KINDS)).collect()]
    assert found[0] == "iban:5:32"
    assert found[1].startswith("ssn:16:27")
    assert found[2] == "email:0:5,email:6:11,email:11:16,ip:17:24,ip:25:32"
    assert found[3:] == ["", "", ""]
    masked = [r.text for r in mask_personal_data(frame).orderBy("doc_id").collect()]
    assert masked[2] == "[EMAIL] [EMAIL][EMAIL] [IP].[IP] 256.1.1.1"
    assert masked[3:] == [None, "", "nothing"]


def test_account_numbers_before_other_capitals(spark):
    texts = {
        "IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFF": (5, 32),
        "IBAN DE89 3704 0044 0532 0130 00 12 EUR": (5, 32),
        "GB82WEST12345698765432 AND NO9386011117947": (0, 22),
        "pay DE89370400440532013000, thanks": (4, 26),
        "NO93 8601 1117 947 BIC DNBANOKK": (0, 18),
        "MT84 MALT 0110 0001 2345 MTLC AST0 01S 2024 EUR": (0, 38),
        "XX89 3704 0044 0532 0130 00 BIC": None,
    }
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    found = [[tuple(s)[:2] for s in r.pii.iban] for r in find_personal_data(frame).orderBy("doc_id").collect()]
    assert [f[:1] for f in found] == [[e] if e else [] for e in texts.values()]
    assert found[2] == [(0, 22), (27, 42)]
    masked = mask_personal_data(frame).orderBy("doc_id").first().text
    assert masked == "IBAN [IBAN] BIC COBADEFF"


def test_secrets(spark):
    texts = {
        'x token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde" From': [(11, 51)],
        "api_key: Zm9vYmFyMTIzNDU2Nzg5MGFiY2RlZg== next": [(9, 41)],
        "the hash 2abc3ff2ca8fb1e4c565a0eb63815530a948bdde of a file": [],
        "token aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1 and token internationalisation-of-names": [],
        "token 11111111112222222222333333333344444444445555": [],
    }
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = [[tuple(s)[:2] for s in r.pii.secret] for r in find_personal_data(frame).orderBy("doc_id").collect()]
    assert found == list(texts.values())
    masked = [r.text for r in mask_personal_data(frame).orderBy("doc_id").collect()]
    assert masked[0] == 'x token = "[SECRET]" From'


def test_many_spans(spark):
    text = "a@b.co " * 1000 + "é 10.0.0.1"
    row = find_personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [s.start for s in row.pii.email] == list(range(0, 7000, 7))
    assert [(s.start, s.end) for s in row.pii.ip] == [(7002, 7010)]


def repeats(text):
    found = words(text)
    places = {}
    for k in range(len(found) - 7):
        places.setdefault(tuple(found[k : k + 8]), []).append(k)
    return len({j for at in places.values() if len(at) > 1 for k in at for j in range(k, k + 8)})


def test_quality_counts(docs):
    rows = quality.judge_quality(docs.selectExpr("*", "'en' lang", "1 as kept"), keep=["doc_id", "text", "kept"]).collect()
    assert len(rows) == docs.count()
    for r in rows:
        text = r.text or ""
        lines = [x for x in text.split("\n") if words(x)]
        assert r.n_words == len(words(text))
        assert r.word_chars == sum(map(len, words(text)))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", text))
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_repeat_words == repeats(text)
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept in (True, False) and not (r.kept and r.base_failed)


def test_quality_model_ways_agree(spark, docs, monkeypatch):
    lang = docs.where("length(text) < 3000").selectExpr("doc_id", "text", "if(doc_id % 3 = 0, 'fr', 'en') lang")
    one = quality.judge_quality(lang, keep=["doc_id"]).select("doc_id", "log_prob").collect()
    monkeypatch.setattr(quality, "BROADCAST_ENTRIES", 0)
    monkeypatch.setattr(quality, "GROUP_BYTES", 1 << 15)
    two = quality.judge_quality(lang, keep=["doc_id"]).select("doc_id", "log_prob").collect()

    def key(r):
        return str(r.doc_id), str(r.log_prob)

    assert sorted(map(key, one)) == sorted(map(key, two))


def test_quality_model_is_a_distribution(spark):
    """The probabilities of all characters after a context, seen or not, add up to one."""
    text = "abra cadabra abracadabra a brac " * 3
    counts = quality.gram_counts(spark.createDataFrame([("en", text)], "lang string, text string"))
    p = {r.gram: 2.718281828459045**r.log_prob for r in quality.model(counts).collect()}
    seen = {}
    for gram, value in p.items():
        seen[gram >> 16] = seen.get(gram >> 16, 0) + value
    assert all(0 < v <= 1 + 1e-4 for v in seen.values())


def test_quality_bands_reject_planted_junk(spark):
    """Junk of symbols and of table rows passes the base rules and leaves the band on either side."""
    read = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    marks = ["***", "&&&", "%%%", "$$$", "###"]
    rng = random.Random(4)
    common = "of the as an is on and this that are".split()
    symbols = " ".join(rng.choice(common) + rng.choice(marks) for _ in range(600))
    first = read.where("lang = 'en' and length(text) > 4000").orderBy("doc_id").first()
    cells = " | ".join(words(first.text)[:500])
    planted = spark.createDataFrame([(-1, symbols, "en"), (-2, cells, "en")], "doc_id long, text string, lang string")
    judged = quality.judge_quality(read.unionByName(planted), keep=["doc_id"])
    found = {r.doc_id: r for r in judged.where("not base_failed").collect()}
    assert found[-1].log_prob > found[-1].upper and not found[-1].kept
    assert found[-2].log_prob < found[-2].lower and not found[-2].kept
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    kept = {q: [found[r.doc_id].kept for r in labels if r.quality == q and r.doc_id in found] for q in (0, 1)}
    assert kept[0].count(False) >= 0.5 * len(kept[0])
    assert kept[1].count(True) >= 0.99 * len(kept[1])


def test_quality_empty(spark):
    assert quality.judge_quality(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0


def test_token_counts(docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = count_tokens(docs, path).join(docs, "doc_id").distinct().collect()
    assert rows
    for r in rows:
        expected = library.encode(r.text or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.n_bytes) == (len(expected), len((r.text or "").encode()))
        assert r.over_limit == (len(expected) > 512)


def test_codec(spark, docs):
    path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as file:
        known = codec.pieces(file.read())
    small = docs.where("text is null or length(text) < 6000")
    whole = codec.decode(codec.encode(small, path), path).collect()
    split = codec.encode(small, path, chunk=64).collect()
    assert len(whole) == len(split) == small.count()
    score, ids = {}, {}
    for r in whole:
        ids[r.doc_id, r.text] = r.ids
        plain = (r.text or "").replace("▁", " ")
        assert r.decoded == plain
        blanks = " " * bool(plain) + plain
        blanks = blanks.replace(" ", "▁")
        best = codec.forward(blanks, len(blanks), known)[0][len(blanks)]
        score[r.doc_id, r.text] = best
        assert codec._path_score(r.ids, known) == pytest.approx(best)
    for r in split:
        assert codec._path_score(r.ids, known) == pytest.approx(score[r.doc_id, r.text])
        assert r.ids == ids[r.doc_id, r.text]
        assert r.n_chunks > 1 or len(r.text or "") < 64
    with pytest.raises(ValueError, match="longest"):
        codec.encode(small, path, chunk=8)


def test_codec_edge_cases(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    long = "".join(random.Random(3).choice(["the ", "aab", "ba", "é", "\n", "  "]) for _ in range(60_000))
    rows = [(1, long, "x"), (1, long, "x"), (2, "aa" * 20_000, "y"), (None, "no id", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, decoded string")
    done = codec.decode(codec.encode(frame, path), path).collect()
    assert sorted((r.doc_id or 0, r.decoded) for r in done) == sorted((i or 0, t) for i, t, _ in rows)
    assert [r.n_chunks > 1 for r in done if r.doc_id] == [True] * 3
    assert len({tuple(r.ids) for r in done if r.doc_id == 1}) == 1
    empty = frame.limit(0)
    assert codec.decode(codec.encode(empty, path), path).count() == 0
    odd = spark.createDataFrame([([5, -1, 10**6, None],), (None,), ([],)], "ids array<int>")
    assert [r.decoded for r in codec.decode(odd, path).collect()][1:] == ["", ""]


def test_remembered_units_are_bounded(monkeypatch):
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        known = codec.pieces(file.read())
    monkeypatch.setattr(codec, "REMEMBERED", 10_000)
    known.memory.clear()
    known.remembered = 0
    expected = {}
    for k in range(40):
        units = [f" word{k}{j}" for j in range(30)] + [" the"]
        found = codec._remembered(units, known)
        expected[" the"] = expected.setdefault(" the", found[-1])
        assert found[-1] == expected[" the"] and len(known.memory) < 200
    assert codec._remembered([" x" * 30_000], known) and known.remembered < 30_000


@pytest.mark.parametrize("work", ["units", "grams"])
def test_arrays_of_a_slice_are_small(spark, work):
    """What a worker holds besides 8 MB of texts stays far below the arrays of 4 MB of them at once."""
    import tracemalloc

    import pyarrow as pa

    rng = random.Random(3)
    known_words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(2000)]
    texts = [" " + " ".join(rng.choices(known_words, k=300)) for _ in range(4000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(["en"] * len(texts))], ["text", "lang"])
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        known = codec.pieces(file.read())

    class Recorded:
        """Runs what an operator gives to mapInArrow on one batch, in this process."""

        def select(self, *names):
            return self

        def mapInArrow(self, run, schema):
            for _ in run(iter([batch])):
                pass
            return self

        def groupBy(self, *names):
            return self

        def agg(self, *columns):
            return self

    tracemalloc.start()
    try:
        if work == "grams":
            quality.gram_counts(Recorded())
        else:
            for some in codec.slices(iter([batch]), "text", codec.SMALL_SLICE):
                codec._encoded(some.column("text"), known)
        assert tracemalloc.get_traced_memory()[1] < 120 << 20
    finally:
        tracemalloc.stop()


def test_scan_is_sequential_product():
    import numpy as np

    rng = np.random.default_rng(1)
    stack = rng.integers(-9, 0, (13, 4, 4)).astype(float)
    out = codec.scan(stack)
    run = stack[0]
    for k in range(1, 13):
        run = codec.combine(run, stack[k])
        assert (out[k] == run).all()


def shingles(text, size):
    found = words((text or "").translate({k: k + 32 for k in range(65, 91)}))
    if not found:
        return frozenset()
    return frozenset(tuple(found[k : k + size]) for k in range(max(1, len(found) - size + 1)))


def groups(rows, size):
    """Smallest id reachable over links, for rows that have an id."""
    sets = [(i, shingles(t, size)) for i, t in rows if i is not None]
    label = {i: i for i, _ in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                low, high = sorted((root(i), root(j)))
                label[high] = low
    return {i: root(i) for i, _ in sets}


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates(spark, size):
    base = [f"w{k}" for k in range(60)]
    rows = [(i, " ".join(base)) for i in (5, 7, 7)]
    rows += [(20 + k, " ".join([*base[:-1], f"x{k}"])) for k in range(30)]  # near copies, linked by the base
    rows += [(100 + k, " ".join([*base[k:], *(f"y{j}" for j in range(k))])) for k in range(0, 40, 2)]  # a chain
    rows += [(200, None), (201, ""), (202, "Short One"), (203, "short one"), (204, "short"), (None, "short"), (None, "alone here")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_duplicates(frame, size=size).collect()
    assert len(found) == len(rows)
    expected = groups(rows, size)
    for r in found:
        if r.doc_id is not None:
            assert r.component_id == expected[r.doc_id], r
            assert r.kept == (r.doc_id == r.component_id)
    loose = sorted((r.component_id or 0, r.kept) for r in found if r.doc_id is None)
    assert loose == [(0, True), (204, False)]


def families(rng, sizes, core, own):
    """Documents of a common core and words of their own: alike, but no copies."""
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    out = []
    for size in sizes:
        common = [word() for _ in range(core)]
        out += [" ".join(common[: core // 2] + [word() for _ in range(own)] + common[core // 2 :]) for _ in range(size)]
    return out


def test_near_duplicates_of_one_core_are_not_compared_in_pairs(spark, monkeypatch):
    """Members of large buckets without links must not meet each other, nor lose the links there are."""
    from nestweave.llm import near_duplicates as module

    met = []
    plausible = module._plausible

    def counted(pairs, *rest):
        met.append(pairs.count())
        return plausible(pairs, *rest)

    monkeypatch.setattr(module, "_plausible", counted)
    rng = random.Random(9)
    texts = families(rng, [300], 100, 24)
    texts += [t.replace(t.split()[k % 40], "changed", 1) for k, t in enumerate(texts[:40])]  # copies of some
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.component_id for r in near_duplicates(frame).collect()}
    assert found == groups(list(enumerate(texts)), 5)
    assert len(set(found.values())) == 300
    assert sum(met) < 340 * 30


def test_near_duplicates_of_one_core_and_a_common_line_are_not_compared_in_pairs(spark, monkeypatch):
    """Lines that many members share beside the core deal those to one bucket; that alone must not make them meet."""
    from nestweave.llm import near_duplicates as module

    met = []
    plausible = module._plausible

    def counted(pairs, *rest):
        met.append(pairs.count())
        return plausible(pairs, *rest)

    monkeypatch.setattr(module, "_plausible", counted)
    rng = random.Random(11)
    texts = families(rng, [320], 100, 30)
    lines = families(rng, [1, 1], 9, 0)  # the lead has one of them at most
    texts = [f"{t} {lines[k % 2]}" for k, t in enumerate(texts)]
    texts += [t.replace(t.split()[k % 40], "changed", 1) for k, t in enumerate(texts[:40])]  # copies of some
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.component_id for r in near_duplicates(frame).collect()}
    assert found == groups(list(enumerate(texts)), 5)
    assert len(set(found.values())) == 320
    assert sum(met) < 360 * 10, met


def test_near_duplicates_of_random_edits(spark):
    """A group whose members lie on either side of the threshold: a few reach the others only over some."""
    rng = random.Random(12)
    core = families(rng, [1], 120, 0)[0].split()
    texts = []
    for k in range(160):
        words_ = list(core[: rng.randint(90, 120)])
        for at in rng.sample(range(len(words_)), rng.choice([0, 1, 2, 3, 4, 6, 9])):
            words_[at] = rng.choice(["x", "y", f"own{k}", f"own{at}"])
        texts.append(" ".join(words_))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.component_id for r in near_duplicates(frame).collect()}
    expected = groups(list(enumerate(texts)), 5)
    assert 5 < len(set(expected.values())) < 150
    assert found == expected


def test_dealt_members_that_are_similar_meet():
    import numpy as np

    from nestweave.llm.near_duplicates import dealt_keys

    rng = np.random.default_rng(5)
    checked = 0
    for _ in range(400):
        base = rng.choice(1000, rng.integers(20, 80), replace=False)
        some = [np.unique(np.concatenate((rng.permutation(base)[: rng.integers(len(base) * 5 // 6, len(base) + 1)],
                                          rng.choice(60, rng.integers(0, 5)) + 1000))) for _ in range(3)]
        lead, x, y = (s.astype(np.int64) for s in some)
        both = len(np.intersect1d(x, y))
        if 100 * both >= 80 * (len(x) + len(y) - both):
            checked += 1
            (one, in_x), (two, in_y) = dealt_keys(lead, x, 7, 80), dealt_keys(lead, y, 7, 80)
            assert np.intersect1d(one, two).size
            most = min(in_x, in_y) + min(len(x) - in_x, len(y) - in_y)
            assert 180 * most >= 80 * (len(x) + len(y))
    assert checked > 30


def test_near_duplicates_empty(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_posterior_bounds_keep_the_similar():
    for n, least in least_matches(150, 30, 0.8, 1e-6):
        lost = sum(math.comb(n, k) * 0.8**k * 0.2 ** (n - k) for k in range(least))
        assert lost < 1e-5  # of pairs at the threshold itself


def test_benchmark_matches(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    benchmark = [(1, item), (2, "two words"), (3, ""), (4, None), (5, item)]
    rows = [
        (10, "before it " + item + " after it"),
        (11, item.replace("alpha", "other")),  # 15 of 17 shingles are shared
        (12, item.replace("kappa", "other")),  # 5 of 16 windows differ
        (13, "some two words here"),
        (14, "two"),
        (15, None),
        (None, item),
        (16, " ".join(item.split()[:10])),
    ]
    found = benchmark_matches(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(benchmark, "item_id long, text string")
    ).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(10, 1), (10, 5), (11, 1), (11, 5), (None, 1), (None, 5), (13, 2)}
    assert {(r.word, r.n_words, r.similarity) for r in found if r.doc_id == 10} == {(2, 20, 1.0)}
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert benchmark_matches(spark.createDataFrame(rows, "doc_id long, text string"), nothing).count() == 0


def test_benchmark_items_in_shorter_texts(spark):
    item = [f"w{k}" for k in range(40)]
    items = spark.createDataFrame([(1, " ".join(item)), (2, "two words"), (5, " ".join(item))], "item_id long, text string")
    rows = [(1, item[1:]), (2, item[1:10]), (3, item[:-3]), (4, ["so"]), (5, []), (6, item[9:] + ["x", "y", "z"]), (None, item[2:])]
    found = benchmark_matches(spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string"), items).collect()
    expected = {(i, k, 0, n) for i, n in ((1, 39), (3, 37), (None, 38)) for k in (1, 5)}
    assert {(r.doc_id, r.item_id, r.word, r.n_words) for r in found} == expected
    assert all(0.9 < r.similarity < 1 for r in found if r.doc_id == 1)
    empty = spark.createDataFrame([(1, "none of these")], "doc_id long, text string")
    assert benchmark_matches(empty, items).count() == 0
