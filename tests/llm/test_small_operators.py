"""Line dedup, shards, quality measures, packing and packed output, against plain Python."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from cases import CLASH_VALUES, CLASHING, SCHEMA, awkward, rows, sentences
from tokenizers import Tokenizer

from tidemark.llm import chat, line_dedup, packing, quality, queries, sharding, token_output, tokens

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BLANKS = " \t\n\x0b\x0c\r"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


def key(doc_id):
    return (doc_id is not None, doc_id)


def deduped(table):
    """Brute force; rows equal in id and text are one document."""
    docs = sorted({(r[0], r[1]) for r in table if r[1] is not None}, key=lambda d: (key(d[0]), d[1]))
    seen, gone = {}, defaultdict(set)
    for d in docs:
        lines = [(i, x.strip(BLANKS)) for i, x in enumerate(d[1].split("\n"))]
        lines = [x for x in lines if x[1]]
        for k in range(len(lines) - 2):
            window = tuple(x[1] for x in lines[k : k + 3])
            if seen.setdefault(window, (d, k)) != (d, k):
                gone[d] |= {x[0] for x in lines[k : k + 3]}
    return {d: ("\n".join(x for i, x in enumerate(d[1].split("\n")) if i not in gone[d]), len(gone[d])) for d in docs}


@pytest.mark.parametrize("schema,more", [(SCHEMA, ()), (CLASHING, CLASH_VALUES)])
def test_line_dedup(spark, schema, more):
    table = [r for r in awkward() if r[0] is None or r[0] != 5] + rows(["a b\nc\nd\nq", "z\na b\n \n c\nd\nc"])[:0]
    table = [(i, *r[1:]) for i, r in enumerate(table)] + [(None, table[9][1], None, None, 1)]
    extra = [(900, "a b\nc\nd\nq", "en", "s", 1), (901, "z\na b\n \n c\nd\nc\nd", "en", "s", 1), (901, "z\na b\n \n c\nd\nc\nd", "en", "s", 1)]
    table += extra
    got = line_dedup.drop_repeated_lines(spark.createDataFrame([(*r, *more) for r in table], schema))
    want = deduped(table)
    assert Counter((r[0], r[1], r[-1]) for r in got.collect()) == Counter((r[0], None, 0) if r[1] is None else (r[0], *want[r[0], r[1]]) for r in table)
    assert got.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and got.columns[-1] == "lines_removed"


def test_line_dedup_of_nothing(spark):
    assert line_dedup.drop_repeated_lines(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("schema,more", [(SCHEMA, ()), (CLASHING, CLASH_VALUES)])
def test_shards(spark, schema, more):
    table = awkward() + [(1000 + i, t, "en", "hot", 1) for i, t in enumerate(sentences(9, 200, 8))]
    got = sharding.stratified_shards(spark.createDataFrame([(*r, *more) for r in table], schema), 8, seed=3).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in table
    )
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    of_source = Counter(r[3] for r in table)
    for (_, source), n in Counter((r.shard, r.source) for r in got).items():
        assert abs(n - of_source[source] / 8) < 2.5
    again = sharding.stratified_shards(spark.createDataFrame([(*r, *more) for r in table[::-1]], schema).repartition(5), 8, seed=3).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_shards_of_few_rows(spark):
    assert sharding.stratified_shards(spark.createDataFrame([], SCHEMA), 8).count() == 0
    one = sharding.stratified_shards(spark.createDataFrame([(1, "a", None, None, 1)], SCHEMA), 8).collect()
    assert [(r.shard, r.slot) for r in one] == [(0, 0)]


def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality_measures_and_verdicts(spark):
    texts = [r[1] for r in awkward()] + sentences(2, 60, 300, 30) + ["é % <b>|" * 30, "WHAT A SHOUT HERE!! " * 3 + " ".join(sentences(3, 30, 60))]
    table = rows(texts)
    got = {r.doc_id: r for r in quality.quality_verdicts(spark.createDataFrame([(*r, *CLASH_VALUES) for r in table], CLASHING), sample_rows=20).collect()}
    assert len(got) == len(table)
    for i, text in enumerate(texts):
        r, want = got[i], measures(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, text
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r.base_failed == failed and (not failed or not r.kept)
    assert any(r.kept for r in got.values())
    assert quality.quality_verdicts(spark.createDataFrame([], SCHEMA)).count() == 0


def test_cascade_order_never_changes_the_verdict(spark):
    texts = sentences(5, 40, 200) + ["A!! B!! C!! " * 40, "x | y | z " * 50]
    docs = quality.measured(spark.createDataFrame(rows(texts), SCHEMA))
    rules = quality.standard_rules()
    orders = (rules, rules[::-1], sorted(rules, key=lambda x: x.name))
    verdicts = [quality.cascade(r, known) for r in orders for known in ((), quality.REPORTED)]
    found = docs.select(*(v.alias(f"v{i}") for i, v in enumerate(verdicts))).collect()
    assert all(len(set(r)) == 1 for r in found) and {r.v0 for r in found} == {True, False}


def test_order_of_rules(spark):
    """Cheap rules that reject much come first, dear ones that reject nothing last; another run on the sample agrees."""
    texts = sentences(5, 200, 300) + ["short one"] * 100
    sample = spark.createDataFrame([(t,) for t in texts], "text string").cache()
    rules = quality.standard_rules()
    orders = [[r.name for r in quality.ordered_rules(sample, rules)] for _ in range(2)]
    assert orders[0] == orders[1] and orders[0][0] == "few_words"
    costs = {n: 1.0 for n in quality.MEASURES}
    assert quality.ordered_rules(sample, rules, costs)[0].name == "few_words"
    shouted = spark.createDataFrame([(t.upper(),) for t in texts], "text string")
    assert quality.ordered_rules(shouted, rules, costs)[0].name == "capitals"
    assert quality.ordered_rules(shouted, rules, costs | {"n_capitals": 1e9})[0].name == "few_words"
    assert len(quality.ordered_rules(sample.limit(0), rules, costs)) == len(rules)


def test_without_rejected_keeps_the_rows(spark):
    table = rows([r[1] for r in awkward()] + sentences(2, 60, 300, 30))
    docs = spark.createDataFrame([(*r, *CLASH_VALUES) for r in table], CLASHING)
    kept = quality.without_rejected(docs, sample_rows=20)
    want = {r.doc_id for r in quality.quality_verdicts(docs, sample_rows=20).collect() if r.kept}
    assert kept.columns == docs.columns
    assert {r[0] for r in kept.toDF(*(f"c{i}" for i in range(len(kept.columns)))).collect()} == want
    assert quality.without_rejected(docs.limit(0)).isEmpty()


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_ids_are_the_tokenizers(tokenizer):
    import pyarrow as pa

    texts = [r[1] for r in awkward()] + ["thea. a.b, c.,d .", "<|endoftext|> <|ENDOFTEXT|>", "don't we're 'tis, É è. İ ŉ ſ", "12 3.5 日本 x\x1cy\x85z", "é ﬁ. ẞß", "z" * 3000]
    encoder = tokens.WordEncoder(VOCABULARY, 0)
    for size in (1, 4, len(texts)):
        for a in range(0, len(texts), size):
            ids, bounds = encoder.encode(pa.array(["pad", *texts[a : a + size]]).slice(1))
            for t, x, y in zip(texts[a : a + size], bounds[:-1], bounds[1:], strict=True):
                assert ids[x:y].tolist() == ids_of(tokenizer, t)


def test_packing(spark, tokenizer):
    table = awkward()
    got = packing.packed_documents(spark.createDataFrame([(*r, *CLASH_VALUES) for r in table], CLASHING), VOCABULARY, 64).collect()
    want = Counter()
    for r in table:
        ids = ids_of(tokenizer, r[1])
        for k in range(0, len(ids), 64):
            part = np.array(ids[k : k + 64], "<u4")
            want[r[0], k // 64, k, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for held in places.values():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:i]) for i in range(len(held))] and sum(n for _, n in held) <= 64
    assert len(places) <= 1.02 * -(-sum(r.length for r in got) // 64) + 1
    assert packing.packed_documents(spark.createDataFrame([], SCHEMA), VOCABULARY, 64).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_patterns_use_up_all_runs(seed):
    rng = np.random.RandomState(seed)
    counts = Counter(int(x) for x in rng.randint(1, 33, rng.randint(0, 400)))
    found, left = packing.patterns(counts, 32), Counter()
    for times, used in found:
        assert times > 0 and sum(length * n for length, n in used.items()) <= 32
        for length, n in used.items():
            left[length] += times * n
    assert left == counts


def test_exact_complements_of_one_two_and_three():
    for lengths in ([20, 12], [20, 7, 5], [20, 6, 4, 2], [20, 6, 6], [20, 4, 4, 4]):
        assert [t for t, _ in packing.patterns(Counter(lengths), 32)] == [1]
    assert sum(t for t, _ in packing.patterns({20: 1, 6: 1}, 32)) == 1
    assert sum(t for t, _ in packing.patterns({20: 2, 6: 2, 12: 1}, 32)) == 2


def test_packed_output_round_trip(spark, tokenizer, tmp_path):
    table = awkward()
    stored = token_output.write_packed(spark.createDataFrame([(*r, *CLASH_VALUES) for r in table], CLASHING), VOCABULARY, f"{tmp_path}/packed", capacity=64)
    found = Counter()
    texts = defaultdict(dict)
    for r in stored.collect():
        ids, positions = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        cuts = r.cu_seqlens
        assert len(ids) == len(positions) == 64 and cuts[0] == 0 and len(cuts) == len(r.segments) + 1 and cuts[-1] <= 64
        for a, b, s in zip(cuts[:-1], cuts[1:], r.segments, strict=True):
            assert b - a == s.length and positions[a:b].tolist() == list(range(b - a)) and s.start == 64 * s.piece
            found[s.doc_id, s.piece, tuple(ids[a:b].tolist())] += 1
            texts[s.doc_id][s.piece] = ids[a:b].tolist()
        assert positions[cuts[-1] :].tolist() == list(range(64 - cuts[-1])) and not ids[cuts[-1] :].any()
    want = Counter()
    for r in table:
        ids = ids_of(tokenizer, r[1])
        for k in range(0, len(ids), 64):
            want[r[0], k // 64, tuple(ids[k : k + 64])] += 1
    assert found == want
    assert token_output.write_packed(spark.createDataFrame([], SCHEMA), VOCABULARY, f"{tmp_path}/none", capacity=64).count() == 0


def test_best_fit_takes_the_least_room():
    sequence, offset, used = token_output.best_fit_decreasing(np.array([5, 10, 3, 7, 2, 5]), 10)
    assert used == 4 and sequence.tolist() == [2, 0, 1, 1, 3, 2] and offset.tolist() == [0, 0, 7, 0, 0, 5]


def conversation(*turns):
    return [(c, t, r, x) for c, t, r, x in turns]


def test_tool_calls(spark):
    tools = {"add": [chat.Parameter("a", "integer", True, 0, 9), chat.Parameter("note", "string")]}
    calls = [
        (1, 0, "k1", None, "add", '{"note": "é\\"\\n", "a": 3}'),
        (1, 2, "k2", "k1", "add", '{"a": "3", "b": 1}'),
        (1, 4, "k3", "k2", "add", '{"a": 12}'),
        (1, 5, "k3", "k2", "add", '{"a": 1}'),
        (1, 6, "k4", "gone", "other", "{}"),
        (1, 7, None, None, "add", "{"),
        (1, 8, "c1", "c2", "add", None),
        (1, 9, "c2", "c1", None, "[1]"),
        (None, 0, "k1", None, "add", "{}"),
        (2, 0, "k1", None, "add", '{"a": 1}'),
        (2, 0, "k1", None, "add", '{"a": 1}'),
    ]
    results = [(1, 1, "k1", "four"), (1, 3, "k1", "five"), (1, 9, "k9", ""), (1, 9, None, None), (None, 3, "k1", "n"), (2, 1, "c1", "x")]
    got = chat.link_tool_calls(
        spark.createDataFrame(calls, "conv_id long, turn long, call_id string, parent_id string, name string, arguments string").selectExpr("*", "1 AS level", "2 AS K"),
        spark.createDataFrame(results, "conv_id long, turn long, call_id string, content string").selectExpr("*", "1 AS C"),
        tools,
    )
    found = Counter((r.conv_id, r.turn, r.kind, r.call_id, r.level, r.linked, r.errors) for r in got.collect())
    assert found == Counter(
        [
            (1, 0, "call", "k1", 0, True, ""),
            (1, 2, "call", "k2", 2, False, "type:a;unexpected:b"),
            (1, 4, "call", "k3", 4, False, "range:a"),
            (1, 5, "call", "k3", None, False, "repeated_id"),
            (1, 6, "call", "k4", 0, False, "unknown_tool;unknown_parent"),
            (1, 7, "call", None, None, False, "malformed;no_id"),
            (1, 8, "call", "c1", None, False, "malformed;cycle"),
            (1, 9, "call", "c2", None, False, "unknown_tool;cycle"),
            (None, 0, "call", "k1", 0, True, "missing:a"),
            (2, 0, "call", "k1", 0, False, ""),
            (2, 0, "call", "k1", None, False, "repeated_id"),
            (1, 1, "result", "k1", 1, True, ""),
            (1, 3, "result", "k1", None, False, "repeated_id"),
            (1, 9, "result", "k9", None, False, "no_call"),
            (1, 9, "result", None, None, False, "no_id"),
            (None, 3, "result", "k1", 1, True, ""),
            (2, 1, "result", "c1", None, False, "no_call"),
        ]
    )
    texts = {(r.conv_id, r.turn, r.kind): r.json for r in got.collect()}
    assert texts[1, 0, "call"] == '{"arguments":{"a":3,"note":"é\\"\\n"},"id":"k1","name":"add","type":"call"}'
    assert texts[1, 1, "result"] == '{"call_id":"k1","content":"four","type":"result"}'


def called(spark, tools, arguments):
    calls = spark.createDataFrame([(1, i, f"k{i}", None, "f", a) for i, a in enumerate(arguments)], "conv_id long, turn long, call_id string, parent_id string, name string, arguments string")
    results = spark.createDataFrame([], "conv_id long, turn long, call_id string, content string")
    return [(r.errors, r.json) for r in chat.link_tool_calls(calls, results, tools).orderBy("turn").collect()]


def test_numbers_have_one_form_and_bad_arguments_stay(spark):
    tools = {"f": [chat.Parameter("x", "number")]}
    same = [["1", "1.0", "1e0", "10E-1", "0.1e1"], ["100", "1e2", "100.00"], ["0.1", "0.10", "1e-1"], ["0.00001", "1e-5", "1.0E-05"], ["0", "-0", "0.0", "-0.0"], ["12345678901234567890123"]]
    flat = [n for group in same for n in group]
    found = called(spark, tools, [f'{{"x": {n}}}' for n in flat])
    assert all(not errors for errors, _ in found)
    spelt = [j.split('"x":')[1].split("}")[0] for _, j in found]
    for group in same:
        assert len({spelt[flat.index(n)] for n in group}) == 1
    assert {"1", "100", "0", "0.1", "12345678901234567890123"} <= set(spelt)
    kept = called(spark, tools, ['{"x": 1', '{"x": 1, "x": 2}', '{"x": 01}', '{"x": "1.0 \\" 2.50 e5"}', None, ""])
    assert [e for e, _ in kept] == ["malformed", "malformed", "malformed", "type:x", "malformed", "malformed"]
    assert '"raw_arguments":"{\\"x\\": 1, \\"x\\": 2}"' in kept[1][1] and '"raw_arguments"' in kept[0][1] and '"raw_arguments"' in kept[2][1]
    assert '{"x":"1.0 \\" 2.50 e5"}' in kept[3][1], "numbers in strings are left alone"


def test_kinds_of_parameters(spark):
    tools = {
        "f": [
            chat.Parameter("a.b", "integer", least=1),
            chat.Parameter("it's \"c\"", "number", most=2.5),
            chat.Parameter("list", "array", least=1, most=2),
            chat.Parameter("map", "object", least=1),
            chat.Parameter("unit", "string", values=("km", "mile")),
            chat.Parameter("flag", "boolean"),
        ]
    }
    cases = {
        '{"a.b": 3.0, "it\'s \\"c\\"": 2.5, "list": [1], "map": {"k": null}, "unit": "km", "flag": true}': "",
        '{"a.b": 0}': "range:a.b",
        '{"a.b": 1.5, "unit": "feet"}': "type:a.b;value:unit",
        '{"it\'s \\"c\\"": 2.6, "list": [], "map": {}}': "range:it's \"c\";range:list;range:map",
        '{"list": [1, 2, 3], "map": [1], "flag": "true"}': "range:list;type:flag;type:map",
        '{"list": {"a": 1}, "unit": 5}': "type:list;type:unit",
        '{"flag": null}': "type:flag",
    }
    assert [e for e, _ in called(spark, tools, list(cases))] == list(cases.values())


def test_calls_of_nothing_and_very_long_arguments(spark):
    tools = {"f": [chat.Parameter("x", "string", least=10_000)]}
    assert called(spark, tools, []) == []
    long = "é" * 300_000
    ((errors, text),) = called(spark, tools, ['{"x": "' + long + '"}'])
    assert errors == "" and long in text
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.link_tool_calls(chat.exchanged_calls(empty), chat.exchanged_results(empty), chat.TOOLS).isEmpty()
    assert chat.link_tool_calls(chat.structured_calls(empty), chat.structured_results(empty), chat.TOOLS).isEmpty()


def test_levels_of_a_long_chain(spark):
    calls = spark.range(300).selectExpr("1L AS c", "cast(id AS string) AS k", "cast(id - 1 AS string) AS up")
    assert {r.k: r.level for r in chat.levels(calls).collect()} == {str(i): i for i in range(300)}


def test_structured_messages(spark):
    messages = [
        (1, 0, "user", "hi"),
        (1, 1, "assistant", '{"tool_calls": [{"id": "a", "name": "add", "arguments": {"x": [1, 2]}}, {"id": "b", "name": "n", "arguments": {}}]}'),
        (1, 2, "tool", '{"tool_call_id": "a", "content": "3"}'),
        (1, 3, "assistant", "plain"),
        (1, 4, "assistant", None),
    ]
    table = spark.createDataFrame(messages, "conv_id long, turn long, role string, text string")
    assert [(r.turn, r.call_id, r.arguments) for r in chat.structured_calls(table).orderBy("call_id").collect()] == [(1, "a", '{"x":[1,2]}'), (1, "b", "{}")]
    assert [(r.turn, r.call_id, r.content) for r in chat.structured_results(table).collect()] == [(2, "a", "3")]


def test_queries_match_sql(spark):
    from compare import compare, connect

    con = connect("/root/testdata/sf0.001")
    for name, sql in queries.ORACLE.items():
        assert compare(queries.QUERIES[name](spark, "/root/testdata/sf0.001"), con, sql) is None, name
