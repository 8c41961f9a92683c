import hashlib
import itertools
import random
import re
import zlib

import pytest

from cardpulse.llm import conversations as c

SCHEMA = "conv_id long, turn long, role string, text string, seen boolean, n int"
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if hit == 0:
            continue
        if hit == 1:
            text = ""
        if hit == 2:
            text = re.sub("[.!?]", "", text)
        if hit == 4:
            role = "user"
        out.extend([(conv, turn, role, text)] * (2 if hit == 3 else 1))
    return out


def lightest(rows):
    """All edit sequences of a short conversation, tried one by one: (cost, audit, turns)."""
    n, best = len(rows), None
    limit = 3 * n
    gaps = [[""], *[["".join(x) for x in itertools.product("ua", repeat=k)] for k in (1, 2)]]
    inserts = [x for group in gaps for x in group]

    def go(i, cost, audit, turns):
        nonlocal best
        if cost > limit:
            return
        for more in inserts:
            price, a, t = cost + 2 * len(more), audit + "I" * len(more), turns + [("user" if x == "u" else "assistant", "") for x in more]
            if price > limit:
                continue
            if i == n:
                if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "#" for r, _ in t)):
                    if best is None or (price, a) < best[:2]:
                        best = (price, a, t)
                continue
            role, text, must, cut = rows[i]
            go(i + 1, price + 3, a + "D", t)
            if not must:
                go(i + 1, price + cut, a + "K", t + [(role, text)])
                for other in ("user", "assistant"):
                    go(i + 1, price + 2 + cut, a + "R", t + [(other, text)])

    go(0, 0, "", [])
    return best


def faults(own):
    seen, out = set(), []
    for role, text in own:
        visible = VISIBLE.findall(text)
        fault = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault in ("blank", "duplicate"), fault == "truncated", fault))
    return out


def brute(rows, solve):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in damage(rows) if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        marked = faults([r[2:] for r in own])
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, repaired = solve([m[:4] for m in marked])
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        out[conv] = (gaps, *(sum(m[4] == f for m in marked) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def forward(rows):
    """A plain table over prefixes keeping all equal-cost audits is too large; audits are kept whole per state instead."""
    ways = {0: (0, "", [])}

    def more(ways):
        ways = dict(ways)
        for _ in range(3):
            for s, (cost, audit, turns) in list(ways.items()):
                for letter, to in c.MOVES[s].items():
                    if letter != "s" and (to not in ways or (cost + 2, audit + "I") < ways[to][:2]):
                        ways[to] = (cost + 2, audit + "I", turns + [(c.ROLES[letter], "")])
        return ways

    ways = more(ways)
    for role, text, must, cut in rows:
        new = {}

        def offer(s, way):
            if s not in new or way[:2] < new[s][:2]:
                new[s] = way

        for s, (cost, audit, turns) in ways.items():
            offer(s, (cost + 3, audit + "D", turns))
            for letter, to in c.MOVES[s].items():
                if not must and role[:1] == letter:
                    offer(to, (cost + cut, audit + "K", turns + [(role, text)]))
                if not must and letter != "s":
                    offer(to, (cost + 2 + cut, audit + "R", turns + [(c.ROLES[letter], text)]))
        ways = more(new)
    return min((ways[s] for s in (0, 3) if s in ways), key=lambda w: w[:2])


def result(spark, rows):
    df = c.damaged_and_repaired(spark.createDataFrame([(*r, False, 1) for r in rows], SCHEMA))
    got = df.collect()
    out = {r["conv_id"]: tuple(r)[1:] for r in got}
    assert len(out) == len(got)
    return out


def test_agenda_against_all_edit_sequences():
    rnd = random.Random(1)
    for _ in range(250):
        rows = [(rnd.choice(["user", "assistant", "system", " ", ""]), f"t{i}", rnd.random() < .25, rnd.random() < .3) for i in range(rnd.randrange(0, 5))]
        rows = [(r, t, must, cut and not must) for r, t, must, cut in rows]
        ways = c.lightest([(r[:1], must, cut, 0) for r, _, must, cut in rows], c.ACCEPTING, (c.START,))
        assert ways[c.START] == lightest(rows)[:2] == forward(rows)[:2], rows


@pytest.mark.parametrize("chunk", [1, 2, 3, 128])
def test_tables_combine_to_the_whole(chunk, monkeypatch):
    """Chunks of any length give what the whole conversation gives."""
    rnd = random.Random(chunk)
    for _ in range(60):
        rows = [(rnd.choice(["user", "user", "assistant", "system"]), f"t{i}", rnd.random() < .2, False) for i in range(rnd.randrange(1, 25))]
        fold = c._Conversation()
        for lo in range(0, len(rows), chunk):
            own = rows[lo:lo + chunk]
            ways = [c.lightest([(r[:1], m, cut, 0) for r, _, m, cut in own], (j,)) for j in range(4)]
            table = [ways[j].get(i, (-1, "")) for i in range(4) for j in range(4)]
            fold.add({"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "first": "u", "last": "u", "turns": 0, "costs": [x for x, _ in table], "audits": [a for _, a in table],
                      "roles": [r for r, *_ in own], "texts": [t for _, t, *_ in own], "counts": [1] * len(own)})
        got = fold.result()
        cost, audit, turns = forward(rows)
        assert got[5:] == [cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()]


def made(rnd, n, lengths):
    rows = []
    for conv in range(n):
        turn = 0
        for _ in range(rnd.choice(lengths)):
            turn += rnd.choice([1, 1, 1, 2])
            rows.append((conv, turn, rnd.choice(["user", "assistant", "user", "assistant", "system", "tool"]), rnd.choice(["Yes.", "No", "Well!", "  ", f"Text {rnd.random()}.", "So? "])))
    return rows


def test_against_brute_force(spark):
    rnd = random.Random(5)
    rows = [r for r in made(rnd, 120, [0, 1, 2, 3, 4])]
    assert result(spark, rows) == brute(rows, lightest)


def test_edge_rows(spark):
    rnd = random.Random(6)
    rows = made(rnd, 60, [5, 9, 14]) + [(None, 1, "user", "Hi."), (None, None, None, None), (None, None, "assistant", "Oh."), (700, None, "user", None), (700, None, "user", None), (701, 3, "", ""),
                                        (702, 5, "user", "x" * 300_000 + "."), (702, 6, "assistant", "y. " * 50_000)]
    rows += rows[:40] + rows[:10]
    assert result(spark, rows) == brute(rows, forward)
    assert result(spark, []) == {}


def test_hot_conversation_is_cut(spark, monkeypatch):
    rnd = random.Random(7)
    rows = [(1, i, "user" if i % 2 else "assistant", "ok." if rnd.random() < .4 else f"text {i}.") for i in range(3000)] + made(rnd, 30, [3, 8])
    want = brute(rows, forward)
    assert result(spark, rows) == want
    chunks = c._chunks(c._seen_earlier(c.damaged(spark.createDataFrame([(*r, False, 1) for r in rows], SCHEMA))))
    assert chunks.where("conv_id = 1").count() > 10
