"""Token counts, fill-in-middle and conversation repair against the library, plain Python and DuckDB."""

import collections
import hashlib
import heapq
import random
import re

import duckdb
import pytest

from conftest import SF
from stratafold.llm import common, conversation, fim, queries, tokencount

TEXTS = [
    (1, None), (2, ""), (3, "  \n\t "), (4, "the cat sat on the mat"), (4, "the cat sat on the mat"), (4, "another text"),
    (None, "no id here <s> \x00 ☃"), (5, "der Hund und die Katze"), (6, " " * 700), (7, "x" * 3000), (8, "日本語😀é " * 250),
    (9, "▁ ▁a  b" * 200), (10, "a<P>b"), (11, "<S" * 300), (12, "The <M quick\nbrown " * 90)]
ODD = [(i, t, "k", 7, b"d", 1, "f") for i, t in TEXTS]
ODD_COLUMNS = "doc_id bigint, text string, key string, pos int, data binary, n_tokens int, form string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, ODD_COLUMNS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], ODD_COLUMNS)


@pytest.fixture(scope="module")
def model():
    return tokencount.Pieces(tokencount.model_path()).model


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- 11 --------------------------------------------------------------------------------------------

def plain_counts(rows, model):
    return sorted(((i, len((t or "").encode()), len(model.encode(t or ""))) for i, t in rows), key=repr)


def test_token_counts_of_the_query(spark, model):
    docs = [(r.doc_id, r.text) for r in common.table(spark, SF, "documents").collect()]
    found = queries.QUERIES["op11_token_counts"](spark, SF)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted_rows(found.drop("over_limit")) == plain_counts(docs, model)
    assert found.where("over_limit <> (n_tokens > 4096) or over_limit is null").count() == 0


@pytest.mark.parametrize("chunk, overlap", [(1 << 15, 256), (300, 20), (40, 1)])
def test_token_counts_hang_on_no_chunk(odd, model, chunk, overlap):
    """The smallest overlaps hold no proven border, so texts are cut anew with wider ones."""
    found = tokencount.count_tokens(odd, chunk=chunk, overlap=overlap)
    assert sorted_rows(found) == plain_counts(TEXTS, model)


def test_token_counts_of_no_rows(empty):
    assert tokencount.count_tokens(empty).count() == 0
    with pytest.raises(ValueError):
        tokencount.count_tokens(empty, chunk=10, overlap=6)


def test_proven_borders_are_borders_of_the_whole_text(model):
    pieces, rng = tokencount.Pieces.of(tokencount.model_path()), random.Random(5)
    signs = "ab  the\n日😀é—▁.\x00"
    for _ in range(60):
        text = "".join(rng.choice(signs) for _ in range(120))
        begins, ends = pieces.spans(text)
        stable = set(pieces.stable(text).tolist())
        assert stable <= set(ends.tolist())
        for p in rng.sample(sorted(stable), min(5, len(stable))):
            left, right = model.encode(text[:p], out_type=str), model.encode("\n" + text[p:], out_type=str)
            assert left + right[2:] == model.encode(text, out_type=str)


# --- 12 --------------------------------------------------------------------------------------------

def plain_fim(row_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'null' if row_id is None else row_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k:k + 8], 16) for k in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        form, output, chars = "plain", text, (None, None)
    elif h4 % 100 < 20:
        form, output, chars = "spm", f"<S>{s}<P>{p}<M>{m}", (len(p), len(m))
    else:
        form, output, chars = "psm", f"<P>{p}<S>{s}<M>{m}", (len(p), len(m))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (row_id, len(units), form, *chars, sha(output), sha(text)), (row_id, form, output)


def test_fim_query_equals_sql(spark):
    duckdb.sql(f"create or replace view documents as from '{SF}/documents.parquet'")
    found = queries.QUERIES["op12_fill_in_middle"](spark, SF)
    want = duckdb.sql(queries.SQL["op12_fill_in_middle"])
    assert found.columns == want.columns
    assert sorted_rows(found) == sorted(want.fetchall(), key=repr)


@pytest.mark.parametrize("size", [1 << 16, 50, 5])
def test_fim_equals_plain(odd, size):
    pieces = fim.fim_pieces(odd, piece_bytes=size)
    assert pieces.selectExpr("max(length(data))").first()[0] <= size + 3
    assert sorted_rows(fim.fim_digests(pieces)) == sorted((plain_fim(*r)[0] for r in TEXTS), key=repr)
    assert sorted_rows(fim.fim_texts(pieces)) == sorted((plain_fim(*r)[1] for r in TEXTS), key=repr)


def test_fim_text_ids_rates_and_no_rows(spark, empty):
    assert fim.fim_digests(fim.fim_pieces(empty)).count() == 0 == fim.fim_texts(fim.fim_pieces(empty)).count()
    named = spark.createDataFrame([("a", "one two three")] * 3, "doc_id string, text string")
    found = fim.fim_texts(fim.fim_pieces(named, rates=fim.Rates(100, 100))).collect()
    assert len(found) == 3 and {r.form for r in found} == {"spm"} and len({r.output for r in found}) == 1
    assert {r.form for r in fim.fim_texts(fim.fim_pieces(named, rates=fim.Rates(0))).collect()} == {"plain"}


def test_fim_shuffles_texts_once(odd):
    plan = fim.fim_digests(fim.fim_pieces(odd))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(key") == 1


# --- 13 --------------------------------------------------------------------------------------------

def plain_repair(rows):
    """The cheapest edits in order of cost, then audit, by trying all."""
    seen, faults, n = set(), [], len(rows)
    for role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        faults.append("X" if not body or (role, text) in seen else "T" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    after = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    names, heap, done = {"u": "user", "a": "assistant"}, [(0, "", 0, 0, ())], set()
    while True:
        cost, audit, i, q, out = heapq.heappop(heap)
        if i == n and q in (0, 3):
            return cost, audit, "\n".join(out)
        if (audit, i, q) in done or cost > 4 * n + 8:
            continue
        done.add((audit, i, q))
        for x, name in names.items():
            if x in after[q]:
                heapq.heappush(heap, (cost + 3, audit + "I", i, after[q][x], (*out, name + ":")))
        if i == n:
            continue
        role, text = rows[i]
        heapq.heappush(heap, (cost + 4, audit + "D", i + 1, q, out))
        if faults[i] == "X":
            continue
        late = 3 * (faults[i] == "T")
        if role[:1] in after[q]:
            heapq.heappush(heap, (cost + late, audit + "K", i + 1, after[q][role[:1]], (*out, f"{role}:{text}")))
        for x, name in names.items():
            if x in after[q]:
                heapq.heappush(heap, (cost + late + 3, audit + "R", i + 1, after[q][x], (*out, f"{name}:{text}")))


def repaired_in_memory(rows):
    seen, symbols = set(), []
    for role, text in rows:
        symbols.append(conversation.symbol_of(role, text, (role, text) in seen)[0])
        seen.add((role, text))
    runs, left = conversation.runs_of(symbols), conversation._END
    edits, _ = conversation.unrolled(runs, 0, left, True)
    for symbol, k in reversed(runs):
        left = conversation.before_run(symbol, k, left)
    return left[0], "".join(name for name, _ in edits), conversation._joined(conversation.repaired(rows, edits))


def test_repair_equals_all_edits_tried():
    rng = random.Random(3)
    roles, texts = ["system", "user", "user", "assistant", "assistant", "x", ""], ["a.", "b", "  ", "c!", "dd.", "e", "f?"]
    for _ in range(600):
        rows = [(rng.choice(roles), rng.choice(texts)) for _ in range(rng.randrange(6))]
        assert repaired_in_memory(rows) == plain_repair(rows)


def test_long_runs_and_block_matrices():
    rows = [("user", f"{i}.") for i in range(37)] + [("assistant", f"{i}") for i in range(21)]
    symbols = [conversation.symbol_of(*r, False)[0] for r in rows]
    runs = conversation.runs_of(symbols)
    assert [k for _, k in runs] == [37, 21]
    one_by_one = conversation._END
    for s in reversed(symbols):
        one_by_one = conversation._apply(conversation.power(s, 0), one_by_one)
    assert conversation._apply(conversation.matrix_of(runs), conversation._END) == one_by_one
    cost, audit, text = repaired_in_memory(rows)
    assert cost == one_by_one[0] and re.fullmatch("s?(ua)+", "".join(line[0] for line in text.split("\n")))


def duck(folder):
    duckdb.sql(f"create or replace view conversations as from '{folder}/conversations.parquet{'' if folder == SF else '/*.parquet'}'")
    return duckdb.sql(queries.SQL["op13_conversation_repair"])


def test_repair_query_equals_sql(spark):
    found, want = queries.QUERIES["op13_conversation_repair"](spark, SF), duck(SF)
    assert found.columns == want.columns and sorted_rows(found) == sorted(want.fetchall(), key=repr)


ODD_TURNS = [
    (1, None, "user", "hi."), (1, 3, None, None), (1, 3, "assistant", "a."), (1, 9, "user", "b"), (1, 9, "user", "b"),
    (2, 1, "", "x."), (2, 2, "User", "x."), (2, 5, "umpire", "yes\n "), (None, 1, "user", "no id."), (None, None, None, None),
    (3, -4, "system", "be kind."), (4, 1, "assistant", "\x0b"), (5, 7, "user", "z" * 50_000), (5, 8, "assistant", "z" * 50_000)]


@pytest.mark.parametrize("block", [4096, 2])
def test_repair_of_odd_rows_and_long_conversations(spark, tmp_path, monkeypatch, block):
    """Small blocks leave all but the shortest conversations open; one holds a third of all rows."""
    monkeypatch.setattr(conversation, "BLOCK_ROWS", block)
    table = common.table(spark, SF, "conversations")
    hot = table.selectExpr("if(conv_id < 7, 7, conv_id) conv_id", "conv_id * 10 + turn turn", "role", "text")
    rows = hot.union(spark.createDataFrame(ODD_TURNS, hot.schema)).selectExpr("*", "1 conv", "2 gone", "3 at", "4 cost")
    rows.write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.QUERIES["op13_conversation_repair"](spark, str(tmp_path))
    assert sorted_rows(found) == sorted(duck(str(tmp_path)).fetchall(), key=repr)
    summary, turns = conversation.repair(conversation.damaged(rows), with_turns=True)
    lines = collections.defaultdict(list)
    for r in turns.orderBy("at").collect():
        lines[r.conv].append(f"{r.role}:{r.text}")
    for r in summary.collect():
        assert hashlib.sha256("\n".join(lines[r.conv]).encode()).hexdigest() == r.repaired_sha256
        assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in lines[r.conv]))


def test_repair_of_no_rows(spark):
    none = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    summary, turns = conversation.repair(conversation.damaged(none), with_turns=True)
    assert summary.count() == 0 == turns.count()
