"""The operators on documents against brute force, edge cases included."""

import hashlib
import itertools
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
import xxhash

from tierwell.llm import imatch, licenses, mixing, outliers, pieces, quality, queries, simhash, substrings, toxicity

BLANK = " \t\n\x0b\f\r"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def same(df, expected, columns):
    got = sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect())))
    assert got == sorted(map(repr, expected))


# op7


def brute_fingerprint(text, size=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(lowered)
    grams = [" ".join(words[k : k + size]) for k in range(len(words) - size + 1)]
    grams = grams or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(n, linked):
    root = list(range(n))

    def top(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in linked:
        root[top(a)] = top(b)
    return [top(a) for a in range(n)]


def test_simhash_components(docs, rows):
    prints = [brute_fingerprint(r[1]) for r in rows]
    linked = [
        (a, b) for a, b in itertools.combinations(range(len(rows)), 2) if (prints[a] ^ prints[b]).bit_count() <= 2
    ]
    roots = brute_roots(len(rows), linked)
    least = {}
    for r, root in zip(rows, roots, strict=True):
        if r[0] is not None:
            least[root] = min(r[0], least.get(root, r[0]))
    expected = [(r[0], p - (1 << 64) * (p >> 63), least.get(root)) for r, p, root in zip(rows, prints, roots, strict=True)]
    same(simhash.components(docs), expected, ("doc_id", "fingerprint", "component_id"))
    kept = simhash.without_near_copies(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == sorted({least[root] for root in roots if root in least})


def test_near_copies_are_judged_by_their_own_text(spark):
    """Rows without an id, and one id with different texts."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(3, a), (5, a), (5, b), (5, b), (None, a), (None, c), (None, c), (None, c.upper()), (9, b)]
    for files in (1, 4):
        made = spark.createDataFrame(rows, "doc_id long, text string").repartition(files)
        got = [(r.doc_id, (r.text or "").lower()) for r in simhash.without_near_copies(made).collect()]
        assert sorted(got, key=repr) == sorted([(3, a), (5, b), (None, c)], key=repr)


@pytest.mark.parametrize(("shard", "levels"), [(8, 8), (64, 8), (100_000, 8), (8, 1), (8, 2), (16, 3)])
def test_vantage_point_links_lose_no_pair(spark, shard, levels):
    rng = np.random.default_rng(shard)
    seeds = rng.integers(0, 2**64, 150, np.uint64)
    near = [s ^ np.uint64((1 << int(a)) | (1 << int(b))) for s in seeds[:60] for a, b in rng.integers(0, 64, (6, 2))]
    chain = [np.uint64((1 << k) - 1) for k in range(0, 64)]  # each links to the next two only
    dense = [np.uint64((1 << a) | (1 << b)) for a in range(12) for b in range(12)]  # all near zero
    values = np.unique(np.array([*seeds, *near, *chain, *dense], np.uint64))
    linked = [(a, b) for a, b in itertools.combinations(range(len(values)), 2) if int(values[a] ^ values[b]).bit_count() <= 2]
    roots = brute_roots(len(values), linked)
    groups = defaultdict(set)
    for v, r in zip(values.view(np.int64).tolist(), roots, strict=True):
        groups[r].add(v)
    df = spark.createDataFrame([(v,) for v in values.view(np.int64).tolist()], "fingerprint long")
    found = simhash.connected(simhash.links(df, 2, shard, levels)).collect()
    mine = defaultdict(set)
    for r in found:
        mine[r.root] |= {r.node, r.root}
    assert sorted(map(sorted, mine.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)
    assert all(root == min(g) for root, g in mine.items())


def test_subtrees_split_nodes_further(spark):
    """Each native has one leaf, leaves are smaller than nodes, and guests are what the bounds ask for."""
    values = np.unique(np.random.default_rng(1).integers(0, 2**64, 4000, np.uint64))
    rows = [(2 + k % 2, int(v), False) for k, v in enumerate(values.view(np.int64))]
    dealt = spark.createDataFrame(rows, simhash.DEALT)
    made = simhash.dealt_further(dealt, 0.5, 3, 2).collect()
    natives = [(r.fingerprint, r.shard) for r in made if not r.guest]
    assert sorted(f for f, _ in natives) == sorted(v for _, v, _ in rows)
    assert {s >> 3 for _, s in natives} == {2, 3} and all(s >> 3 == dict((v, n) for n, v, _ in rows)[f] for f, s in natives[:50])
    sizes = Counter(s for _, s in natives)
    assert len(sizes) == 16 and max(sizes.values()) < 1000
    leaf = dict(natives)
    assert all(leaf[r.fingerprint] != r.shard and leaf[r.fingerprint] >> 3 == r.shard >> 3 for r in made if r.guest)


# op9


def brute_kept(rows, window=50):
    first = {}
    for r in rows:
        words = (r[1] or "").encode().split()
        for k in range(len(words) - window + 1):
            key = tuple(words[k : k + window])
            rank = math.inf if r[0] is None else r[0]
            first[key] = min(first.get(key, rank), rank)
    for r in rows:
        words = (r[1] or "").encode().split()
        gone = set()
        for k in range(len(words) - window + 1):
            if first[tuple(words[k : k + window])] < (math.inf if r[0] is None else r[0]):
                gone.update(range(k, k + window))
        yield r, words, [w for k, w in enumerate(words) if k not in gone]


@pytest.mark.parametrize("settings", [{}, {"group": 1}, {"window": 12, "prefix": 5, "group": 3}, {"window": 12, "prefix": 5, "group": 40}])
def test_substrings(docs, rows, settings):
    expected = [
        (r[0], len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())
        for r, words, kept in brute_kept(rows, settings.get("window", 50))
    ]
    assert sum(e[2] for e in expected) > 200
    same(substrings.kept_digests(docs, **settings), expected, ("doc_id", "n_words", "n_removed", "kept_sha256"))


def test_substrings_in_small_helpings(docs, rows, monkeypatch):
    monkeypatch.setattr(substrings.repeated_in_groups, "__defaults__", (40,))
    test_substrings(docs, rows, {})


@pytest.mark.parametrize("group", [1_000, substrings.GROUP])
def test_substrings_of_few_texts_with_many_windows(spark, group, monkeypatch):
    """One word over and over is one anchor: few texts, but a group of any size."""
    monkeypatch.setattr(substrings, "RUN", 64)
    rows = [(1, "la " * 700), (2, "x " + "la " * 900 + "y"), (3, "tra la " * 400), (4, "tra la " * 450)]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    expected = [
        (r[0], len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())
        for r, words, kept in brute_kept(rows)
    ]
    same(substrings.kept_digests(made, group=group), expected, ("doc_id", "n_words", "n_removed", "kept_sha256"))
    counted = {r.n_windows for r in substrings.anchors(made, 50, 10).where("row_key is not null").collect()}
    assert 651 in counted  # all windows of the first text have one anchor


def test_kept_texts(docs, rows):
    made = substrings.kept_texts(docs)
    assert made.columns == docs.columns
    expected = [
        (r[0], b" ".join(kept), r[1] if len(words) == len(kept) else None) for r, words, kept in brute_kept(rows)
    ]
    got = [(r.doc_id, (r.text or "").encode(), r) for r in made.collect()]
    assert sorted(repr((i, b" ".join(t.split()))) for i, t, _ in got) == sorted(repr(e[:2]) for e in expected)
    untouched = Counter(repr((e[0], e[2])) for e in expected if e[2] is not None)
    assert not untouched - Counter(repr((i, r.text)) for i, _, r in got)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) and r.row_key == 0 for _, _, r in got)


# op3


def test_pieces_match_the_library(docs, rows):
    model = queries.piece_model()
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    expected = []
    for r in rows:
        ids = library.encode(r[1] or "")
        expected.append((r[0], len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)), ids))
    made = pieces.encoded(
        docs, pieces.read_model(model), ["n_tokens", "ids_sha256", "decoded_sha256", "ids", "begins", "ends"], ("doc_id",)
    )
    same(made, expected, ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"))
    texts = defaultdict(list)
    for r in rows:
        texts[r[0]].append((r[1] or "").encode())
    for r in made.collect():  # spans tile the text
        assert r.begins[1:] == r.ends[:-1]
        if r.ends:
            assert r.begins[0] == 0 and r.ends[-1] in [len(t) for t in texts[r.doc_id]]


def test_pieces_span_their_bytes():
    model = pieces.PieceModel(pieces.read_model(queries.piece_model()))
    text = "Hi  日🤗 wörld\n"
    ids, spans = model.encode(text)
    for k, (a, b) in zip(ids, spans, strict=True):
        if model.kinds[k] == pieces.NORMAL and a > 0:
            assert model.plain[k].encode() == text.encode()[a:b]
    for word in ("abab" * 200, "x" * 3000, "the" * 50):  # beyond the short way of merging
        assert model.merged(word) == sentencepiece.SentencePieceProcessor(
            model_file=queries.piece_model()
        ).encode("q" + word, out_type=str)[1:] or model.ids_of("▁" + word) == sentencepiece.SentencePieceProcessor(
            model_file=queries.piece_model()
        ).encode(word)


def library_spans(library, text):
    """Begin and end of each piece, in bytes."""
    return [(p.begin, p.end) for p in library.encode(text, return_type="proto").pieces]


def test_the_query_projects_spans_as_the_library(spark, folder, rows):
    library = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
    expected = [
        (r[0], hashlib.sha256(np.array(library_spans(library, r[1] or ""), "<i8").tobytes()).hexdigest()) for r in rows
    ]
    same(queries.op3_pieces(spark, folder), expected, ("doc_id", "spans_sha256"))


def test_spans_under_a_character_map():
    """A model whose normaliser changes characters and squeezes spaces: spans are of the original."""
    import io

    made = io.BytesIO()
    sentencepiece.SentencePieceTrainer.train(
        sentence_iterator=iter(["the fine office fits 1 2 half"] * 50), model_writer=made, model_type="bpe", vocab_size=40,
        normalization_rule_name="nmt_nfkc", hard_vocab_limit=False, minloglevel=2,
    )
    library = sentencepiece.SentencePieceProcessor(model_proto=made.getvalue())
    model = pieces.PieceModel(made.getvalue())
    for text in ("the  ﬁne oﬃce", "①½  ﬁts", "  half ", ""):
        assert model.encode(text) == (library.encode(text), library_spans(library, text))


def test_character_map_matches_the_library():
    library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    spec = dict(pieces.fields(dict(pieces.fields(library.serialized_model_proto()))[3]))
    mapping = pieces.CharacterMap(spec[2])
    for text in ("ﬁ①Å　ｘ", "a\tb", "が ㍿ ½", "plain", "", "ＡＢＣ​d", "éx"):
        mapped, places = mapping.apply(text.encode())
        normal = library.normalize(text).replace("▁", " ").strip()
        assert re.sub(" +", " ", mapped.decode()).strip() == normal
        assert len(places) == len(mapped) + 1 and (np.diff(places) >= 0).all() and places[-1] == len(text.encode())
    mapped, places = mapping.apply("ﬁx".encode())
    assert mapped == b"fix" and places.tolist() == [0, 0, 3, 4]


# op6


def brute_targets(sizes, cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = total - sum(capped.values())
        open_ = [s for s in names if s not in capped]
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > cap * sizes[s]]
        if not over:
            return {**share, **capped}
        capped |= {s: cap * sizes[s] for s in over}


def test_mixing(docs, rows, folder, spark):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(WORDS.findall(r[1] or ""))
    targets = brute_targets(sizes)
    made = queries.op6_mixing(spark, folder).collect()
    assert Counter(r.doc_id for r in made) == Counter(r[0] for r in rows)
    got = mixing.copied(docs).collect()
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        n = len(WORDS.findall(r.text or ""))
        taken[r.source] += n * r.mix_copies
        largest[r.source] = max(largest[r.source], n)
        assert r.mix_words == sizes[r.source]
        assert r.mix_target == pytest.approx(targets[r.source])
        assert 0 <= r.mix_copies <= 3
        if sizes[r.source]:
            assert abs(r.mix_copies - r.mix_target / sizes[r.source]) < 1.001
    for s, t in targets.items():
        assert abs(taken[s] - t) <= largest[s] + 0.1 * t
    again = mixing.copied(docs).collect()
    assert sorted((r.doc_id or 0, r.mix_copies) for r in got) == sorted((r.doc_id or 0, r.mix_copies) for r in again)
    copies = Counter(r.doc_id for r in mixing.mixed(docs).collect())
    assert copies == sum(
        (Counter({r.doc_id: r.mix_copies}) for r in got), Counter()
    )


def test_mixing_in_small_blocks(docs, monkeypatch):
    whole = sorted((r.doc_id or 0, r.mix_copies) for r in mixing.copied(docs).collect())
    monkeypatch.setattr(mixing, "BLOCK", 2)
    assert sorted((r.doc_id or 0, r.mix_copies) for r in mixing.copied(docs).collect()) == whole


# op5


def test_licenses(docs, rows):
    phrases = {label: text.split() for label, text in licenses.PHRASES}
    expected = []
    for r in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1] or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        places = [(k, p) for p, w in phrases.items() for k in range(len(words)) if words[k : k + len(w)] == w]
        score, own = (1.0 if places else 0.0), {p for _, p in places}
        for label, text in licenses.TEMPLATES:
            tokens = set(text.split())
            for start in range(0, len(words), licenses.BLOCK // 2):
                share = len(tokens & set(words[start : start + licenses.BLOCK])) / len(tokens)
                if share >= licenses.THRESHOLD:
                    own.add(label)
                    score = max(score, share)
        starts = [k for k, _ in places]
        expected.append(
            (r[0], len(words), len(starts), min(starts, default=None), max(starts, default=None),
             ",".join(sorted({p for _, p in places})), ",".join(sorted(own)), score)
        )
    made = licenses.scanned(docs)
    same(made, expected, ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"))
    blocks = licenses.block_matches(docs).collect()
    assert {r.label for r in blocks if not r.phrase} >= {"cc-by-nc-4.0", "gpl-3.0"}


def test_licenses_match_wherever_they_stand(spark):
    """Every window, one word apart, also of templates longer than a block."""
    rng = np.random.default_rng(6)
    spread = "licensed under the " + "x " * 12 + "apache license version 2 0"
    long = " ".join(f"clause{k}" for k in range(40))
    texts = ["y " * k + spread for k in range(33)] + ["y " * k + long + " z" for k in range(0, 90, 7)]
    pool = " ".join(t for _, t in licenses.TEMPLATES).split() + long.split() + ["x"] * 20
    texts += [" ".join(rng.choice(pool, int(n))) for n in rng.integers(1, 400, 30)]
    texts += [f"{spread} {' '.join(rng.choice(pool, 40))} {long} {spread}", "", None]
    found = licenses.templates(statements=(*licenses.TEMPLATES, ("long", long)))
    expected, scores = set(), {}
    for i, text in enumerate(texts):
        words = licenses.words_of(text)
        for t in found:
            for start in range(max(len(words) - t.window, 0) + 1):
                share = len(t.tokens & set(words[start : start + t.window])) / len(t.tokens)
                if not t.phrase and share >= licenses.THRESHOLD:
                    expected.add((i, t.label, start))
                    scores[i] = max(share, scores.get(i, 0))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r for r in licenses.block_matches(docs, found).collect() if not r.phrase]
    assert {(r.doc_id, r.label, k) for r in got for k in range(r.start, r.last + 1)} == expected
    made = {r.doc_id: r for r in licenses.scanned(docs, found).collect()}
    assert all(made[i].score == c or made[i].n_base for i, c in scores.items())
    assert all("apache-2.0" in made[k].labels for k in range(33))
    assert all("long" in made[k].labels.split(",") for k in range(33, 46))


# op2


def test_imatch(docs, rows):
    made = imatch.compared(docs).collect()
    order = sorted(
        rows, key=lambda r: (imatch.LAST if r[0] is None else r[0], xxhash.xxh64_intdigest((r[1] or "").encode()))
    )
    total = len(rows)
    seen = Counter(w for r in rows for w in imatch.terms(r[1] or ""))
    band = {w for w, n in seen.items() if max(1, total * imatch.RARE) <= n <= max(1, total * imatch.COMMON)}
    printer = imatch.Printer(imatch.hashed(band))
    expected = []
    for k, r in enumerate(order):
        text, after = r[1] or "", order[(k + 1) % total][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = (printer.print(t) for t in (text, edited, after))
        expected.append((r[0], len(text), sha(edited), "".join(a), "".join(b), imatch.likeness(a, b), imatch.likeness(a, c)))
    got = [tuple(r) for r in made]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))
    assert np.mean([r.near_edited for r in made]) > 3 * np.mean([r.near_next for r in made])
    alone = docs.where("doc_id = 100003")
    assert [r.near_next for r in imatch.compared(alone).collect()] == [1.0]
    assert imatch.fingerprints(docs).count() == total


def plain_slots(text, band):
    """The rule written out with whole numbers: lexicon, subsets by hash, hash of the sorted terms."""
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    own = {m.encode() for m in re.findall("[0-9a-z\x80-\U0010ffff]+", lowered)}
    known = {xxhash.xxh64_intdigest(w) for w in own & band}
    whole = 2**64

    def digest(values, bits):
        raw = b"".join(v.to_bytes(8, "little") for v in sorted(values))
        return f"{xxhash.xxh64_intdigest(raw) >> (64 - bits):0{bits // 4}x}"

    if not known:
        return [digest({xxhash.xxh64_intdigest(w) for w in own}, 64), *["------"] * 32]
    slots = [digest(known, 64)]
    for k in range(32):
        inside = set()
        for v in known:
            h = (v ^ (0x9E3779B97F4A7C15 * (k + 1) % whole)) * 0xFF51AFD7ED558CCD % whole
            h = (h ^ (h >> 33)) * 0xC4CEB9FE1A85EC53 % whole
            if (h ^ (h >> 33)) * 4 ** (1 + k // 8) < whole:
                inside.add(v)
        slots.append(digest(inside, 24) if inside else "------")
    return slots


def test_imatch_by_plain_rule(docs, rows):
    n = len(rows)
    seen = Counter()
    for r in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1] or "")
        seen.update({m.encode() for m in re.findall("[0-9a-z\x80-\U0010ffff]+", lowered)})
    band = {w for w, c in seen.items() if max(1, n / 2000) <= c <= max(1, n / 20)}
    made = defaultdict(set)
    for r in imatch.compared(docs).collect():
        made[r.doc_id].add((r.fingerprint, r.near_next))
    once = [r for r in rows if r[0] is not None and [x[0] for x in rows].count(r[0]) == 1]
    for r in once:
        assert {f for f, _ in made[r[0]]} == {"".join(plain_slots(r[1], band))}
    ids = sorted(r[0] for r in rows if r[0] is not None)
    text = {r[0]: r[1] for r in rows}
    for here, after in zip(ids, ids[1:], strict=False):
        if ids.count(here) == ids.count(after) == 1:
            a, b = plain_slots(text[here], band), plain_slots(text[after], band)
            filled = [(x, y) for x, y in zip(a, b, strict=True) if {x, y} != {"------"}]
            assert {s for _, s in made[here]} == {sum(x == y for x, y in filled) / len(filled)}


def test_texts_without_lexicon_terms_stay_apart(spark):
    texts = [(k, f"only{k} here{k}") for k in range(20_000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    made = imatch.fingerprints(docs, np.empty(0, np.uint64))
    assert made.select("fingerprint").distinct().count() == 20_000


# op10


def test_base_counts(docs, rows):
    expected = []
    for r in rows:
        text = r[1] or ""
        words = WORDS.findall(text)
        lines = [x for x in text.split("\n") if x.strip(BLANK)]
        grams = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
        covered = {k + j for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for j in range(3)}
        expected.append(
            (r[0], len(words), sum(map(len, words)), sum(c in outliers.SYMBOLS for c in text),
             len(lines) - len(set(lines)), len(covered))
        )
    same(outliers.counts(docs), expected, ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))


def test_outliers_find_what_does_not_belong(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(400):
        words = ["w%d" % x for x in rng.integers(0, 5000, int(rng.integers(80, 300)))]
        if k < 20:
            words = [w + "###$$$" for w in words]
        rows.append((k, " ".join(words), "en" if k % 2 else None, "s"))
    made = {r.doc_id: r for r in outliers.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(made[k].kept for k in range(20))
    assert sum(made[k].kept for k in range(20, 400)) >= 379


def test_outliers_of_small_groups(spark):
    """Groups and languages with few documents are judged by larger ones."""
    rng = np.random.default_rng(4)
    rows = []
    for k in range(240):
        words = ["w%d" % x for x in rng.integers(0, 5000, int(rng.integers(80, 300)))]
        if k % 40 == 0:
            words = [w + "###$$$" for w in words]
        lang = "en" if k < 200 else None if k < 230 else f"l{k}"
        rows.append((k, " ".join(words), lang, None if k % 12 == 0 else f"s{k % 12}"))
    schema = "doc_id long, text string, lang string, source string"
    made = outliers.judged(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id, r.lang, r.source) for r in made if r.source and r.lang) == sorted(
        (k, lang, source) for k, _, lang, source in rows if source and lang
    )
    assert len(made) == 240 and all(r.distance is not None for r in made)
    assert not any(r.kept for r in made if r.doc_id % 40 == 0)
    assert sum(r.kept for r in made) >= 230
    alone = outliers.judged(spark.createDataFrame(rows[1:2], schema)).collect()
    assert [(r.kept, r.distance < 1) for r in alone] == [(True, True)]


def test_mahalanobis_distance_and_estimate(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 5)) @ rng.normal(size=(5, 5))
    data = [("en", "s", False, *map(float, row)) for row in x]
    df = spark.createDataFrame(data, "lang string, source string, base_failed boolean, a double, b double, c double, d double, e double")
    got = [r.d2 for r in outliers.with_distance(df, outliers.estimate(df, 1.0)).orderBy("a").collect()]
    cov = np.cov(x.T, bias=True) + np.diag(np.square(outliers.FLOOR))
    diff = x - x.mean(0)
    expected = np.einsum("ij,jk,ik->i", diff, np.linalg.inv(cov), diff)[np.argsort(x[:, 0])]
    assert np.allclose(got, expected)


def test_steps_of_the_estimate_against_numpy(spark):
    """Each step takes exactly the share, and the determinant falls as that of the nearest rows does."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(401, 5)) @ rng.normal(size=(5, 5)) * 3
    x[:60] += 40
    x[60:70] = x[60]  # ties
    schema = "lang string, source string, base_failed boolean, a double, b double, c double, d double, e double"
    df = spark.createDataFrame([("en", None, k % 7 == 0, *map(float, row)) for k, row in enumerate(x)], schema)
    now, mean, cov = outliers.estimate(df, 1.0), x.mean(0), np.cov(x.T, bias=True) + np.diag(np.square(outliers.FLOOR))
    dets = []
    for _ in range(3):
        inside = outliers.nearest(outliers.with_distance(df, now).drop("logdet"), 0.75)
        assert abs(inside.agg({"weight": "sum"}).first()[0] - 0.75 * 401) < 1e-9
        now = outliers.stable(outliers.estimate(inside, outliers.CONSISTENCY))
        d2 = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
        bins = np.floor(64 * np.log2(d2 + 1e-6))
        last = np.sort(bins)[math.ceil(0.75 * 401) - 1]
        weight = np.where(bins < last, 1.0, (0.75 * 401 - (bins < last).sum()) / (bins == last).sum()) * (bins <= last)
        mean = np.average(x, axis=0, weights=weight)
        cov = np.cov(x.T, aweights=weight, bias=True) * outliers.CONSISTENCY + np.diag(np.square(outliers.FLOOR))
        got = now.first()
        assert np.allclose([got[f"m{i}"] for i in range(5)], mean) and math.isclose(got.logdet * 2, np.linalg.slogdet(cov)[1])
        dets.append(got.logdet)
    assert dets == sorted(dets, reverse=True) and abs(mean).max() < 20 < x[:60].mean()
    best = outliers.estimates(df).first()
    assert best.logdet <= dets[-1] + 1e-9


# op1, op8


@pytest.mark.parametrize("name", ["op1_toxicity", "op8_quality"])
def test_classifiers_on_held_out_labels(spark, name):
    folder = "/root/testdata/sf0.1"
    label = {"op1_toxicity": "toxic", "op8_quality": "quality"}[name]
    made = queries.QUERIES[name](spark, folder)
    assert made.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    marked = made.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out")
    got = marked.selectExpr(f"{label} AS mark", "predicted", "score").collect()
    assert sum(r.mark == r.predicted for r in got) >= 0.95 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_classifiers_take_edge_cases(docs, rows, labels, spark):
    for scored in (toxicity.scored, quality.scored):
        made = scored(docs, labels).collect()
        assert Counter(r.doc_id for r in made) == Counter(r[0] for r in rows)
        assert all(0 <= r.score <= 1 and r.held_out is not None for r in made)
        no_labels = labels.selectExpr("doc_id", "cast(null AS int) AS quality", "1 AS toxic").limit(5)
        assert len({r.score for r in scored(docs, no_labels).collect()}) == 1
    assert quality.accepted(docs, labels).columns == docs.columns


def sample_of(spark, rows):
    return spark.createDataFrame([(k, m, t) for k, (t, m) in enumerate(rows)], "doc_id long, mark int, text string")


def test_offending_sentences_are_located(spark):
    clean = ["the quick fox. it runs home! all is well", "a calm day\nbirds sing. rain falls"]
    rows = [(clean[k % 2] + f" item {k}", 0) for k in range(200)]
    rows += [(clean[k % 2] + f". you utter moron. bye {k}", 1) for k in range(200)]
    model = toxicity.fit(sample_of(spark, rows))
    text = "birds sing. you utter moron. all is well"
    worst = max(model.sentences(text), key=lambda s: s[2])
    assert text[worst[0] : worst[1]].strip() == "you utter moron"
    assert model.score(text) >= 0.5 > model.score("birds sing. all is well")
    # Length alone is no evidence.
    long = "birds sing. rain falls. unheard words\n" * 20_000
    assert model.score(long) < 0.5 <= model.score(long + "you utter moron")
    assert model.score("nothing known here. " * 20_000) == model.score("") == model.score(None)
    table = spark.createDataFrame(
        [(1, text), (1, text), (2, None), (None, "you utter moron! Oh you utter moron"), (3, ""), (4, long + "you utter moron")],
        "doc_id long, text string",
    )
    found = sorted((r.doc_id or 0, r.start, r.stop) for r in toxicity.offending(table, model).collect())
    at = (text.index(". you") + 1, text.index(". all"))
    assert found == [(0, 0, 15), (0, 16, 35), (1, *at), (1, *at), (4, len(long), len(long) + 15)]


def test_training_reads_whole_texts(spark):
    """The only word that tells the classes apart stands behind 30,000 characters."""
    filler = "birds sing and rain falls on a calm day. " * 750
    texts = [(k, f"{filler} item{k}. " + ("you utter moron" if k % 2 else "good bye now")) for k in range(120)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "doc_id % 2 AS toxic", "1 - doc_id % 2 AS quality")
    for name, made in (("toxic", toxicity.scored(docs, labels)), ("quality", quality.scored(docs, labels))):
        got = made.join(labels, "doc_id").where("held_out").collect()
        assert len(got) > 10 and all((r.score >= 0.5) == (r[name] == 1) for r in got)
    where = toxicity.scored(docs, labels).where("doc_id % 2 = 1").collect()
    assert all(r.n_offending == 1 and r.worst_start > 30_000 for r in where)


# all


@pytest.mark.parametrize(
    "run",
    [simhash.components, simhash.without_near_copies, substrings.kept_digests, substrings.kept_texts, imatch.compared,
     licenses.scanned, mixing.copied, mixing.mixed, outliers.judged],
)
def test_empty_tables(empty, run):
    assert run(empty).count() == 0


def test_empty_tables_with_models(empty, labels):
    assert toxicity.scored(empty, labels).count() == 0
    assert quality.scored(empty, labels.limit(0)).count() == 0
    assert pieces.encoded(empty, pieces.read_model(queries.piece_model()), ["n_tokens"]).count() == 0
