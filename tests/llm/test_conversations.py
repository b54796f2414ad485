"""Conversation repair against a plain relaxation, the SQL on odd rows, and itself in small pieces."""

import random

import duckdb
import pandas as pd
import pytest

from tessera.llm import conversations as C
from tests.llm.cases import both

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def relaxed(turns):
    """The least (cost, audit) of a conversation, by relaxing every label of a turn until nothing changes."""
    labels = {(0, C.START): (0, "")}
    for index in range(len(turns) + 1):
        changed = True
        while changed:
            changed = False
            for (at, state), (cost, audit) in list(labels.items()):
                if at != index:
                    continue
                for more, initial, to, then in C.edits(turns, at, state):
                    made = (cost + more, audit + initial)
                    if made < labels.get((to, then), (10**9, "")):
                        labels[to, then] = made
                        changed = True
    return min(labels[k] for k in ((len(turns), C.START), (len(turns), C.ASSISTANT)) if k in labels)


def turns(rng, n):
    return [(rng.choice(["user", "assistant", "system", "tool", "", "agent"]), "x", rng.random() < 0.2, rng.random() < 0.3) for _ in range(n)]


def test_search_finds_the_least_edits():
    rng = random.Random(1)
    for n in [*range(9), *range(9), 30]:
        own = turns(rng, n)
        assert C.cheapest(own) == relaxed(own)


def test_hand_made_repairs():
    ok = lambda *roles: [(r, "Yes.", False, False) for r in roles]
    assert C.cheapest([]) == (0, "")
    assert C.cheapest(ok("system", "user", "assistant")) == (0, "KKK")
    assert C.cheapest(ok("user")) == (2, "KI")
    assert C.cheapest(ok("assistant")) == (2, "IK")
    assert C.cheapest(ok("user", "system", "assistant")) == (3, "KDK")
    assert list(C.repaired(ok("user", "user"), "KR")) == ["user:Yes.", "assistant:Yes."]
    assert C.cheapest([("user", "cut", False, True), ("assistant", "Yes.", False, False)]) == (1, "KK")


def odd_rows():
    rng = random.Random(7)
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    words = ["Yes.", "no", "What?", "Stop!", "", " \t", None, "\x0b\x0c", "Ends. ", "é…", "a.\nb", "same text.", "same text.", " "]
    own = []
    for conv in [*range(40), None]:
        for turn in range(rng.randrange(1, 14)):
            own.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), rng.choice(roles), rng.choice(words)))
    own += [(500, k, "user" if k % 2 == 0 else "assistant", f"turn {k // 5}.") for k in range(700)]
    own += [(501, 3, "user", "again and again.")] * 900
    own += [(502, k, "user", "the same.") for k in range(300)]
    own += [(503, 0, "user", "x" * 200_000)]
    return own


def by_sql(own):
    con = duckdb.connect()
    con.register("given", pd.DataFrame(own, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"}))
    con.sql("CREATE TABLE conversations AS SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, role::VARCHAR AS role, text::VARCHAR AS text FROM given")
    return sorted(con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({C.OP12_SQL})").fetchall(), key=repr)


def table(spark, own):
    clashing = [(*r, 1, "x", True) for r in own]
    return spark.createDataFrame(clashing, "conv_id long, turn long, role string, text string, cost int, audit string, whole boolean")


@pytest.mark.parametrize("piece", [2, 7, C.PIECE])
def test_odd_rows_as_by_sql(spark, piece):
    own = odd_rows()
    assert both(C.repair(C.damaged(table(spark, own)), piece), *COLUMNS) == by_sql(own)


def test_no_rows(spark):
    assert C.repair(C.damaged(table(spark, []))).collect() == []


def test_undamaged_conversations_stay(spark):
    own = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hello."), (1, 2, "assistant", "Hi!"), (2, 0, None, None)]
    got = {r["conv_id"]: r for r in C.repair(C.undamaged(table(spark, own))).collect()}
    assert (got[1]["audit"], got[1]["cost"], got[1]["illegal"]) == ("KKK", 0, 0)
    assert (got[2]["audit"], got[2]["cost"], got[2]["blank"]) == ("D", 3, 1)
