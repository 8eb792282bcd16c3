from __future__ import annotations

import itertools
import random

from strandlake.llm import toxicity
from strandlake.llm.transducers import Transducer, build, compose


def by_hand(symbols):
    """Channels straight from the rules: what each insult and threat of a clause is."""
    out = []
    for i, x in enumerate(symbols):
        reported = "R" in symbols[:i]
        negated = "N" in symbols[max(0, i - toxicity.NEGATION_REACH) : i]
        target = lambda reach: ("Y" in symbols[max(0, i - reach) : i], "Y" in symbols[i + 1 : i + 1 + reach])  # noqa: B023, E731
        if x == "I":
            out.append("r" if reported else "n" if negated else "t" if any(target(toxicity.INSULT_REACH)) else "p")
        elif x == "T" and not reported and not negated:
            before, after = target(toxicity.THREAT_REACH)
            out.append("K" if after else "k" if before else "W")
        else:
            out.append(x)
    return [o for o in out if o in toxicity.WRITTEN]


def test_grammar_against_the_rules():
    machine = toxicity.grammar()
    r = random.Random(3)
    cases = ["".join(c) for k in range(5) for c in itertools.product(toxicity.READ, repeat=k)]
    cases += ["".join(r.choice("IITTYNRWWWWWW") for _ in range(r.randint(5, 40))) for _ in range(3000)]
    for symbols in cases:
        _, out = machine.best(symbols)
        assert [o for o in out if o in toxicity.WRITTEN] == by_hand(symbols), symbols


def test_best_path_against_all_paths():
    """The composed machine's best path against every path of it, and against all paths of its parts run one after the other."""
    parts = [
        toxicity.report(), toxicity.negation(), toxicity.near("I", "p", "t", "t", (1.0, 1.0), toxicity.INSULT_REACH, "ITYWrn"),
        toxicity.near("T", "W", "k", "K", (1.0, 2.0), toxicity.THREAT_REACH, "TYWrnpt"),
    ]
    machine, r = toxicity.grammar(), random.Random(8)
    for _ in range(150):
        symbols = "".join(r.choice("ITTIYNRWW") for _ in range(r.randint(0, 9)))
        paths = machine.paths(symbols)
        want = min(paths, key=lambda p: (-p[0], p[1]))
        assert machine.best(symbols) == want
        chained = [(0.0, tuple(symbols))]
        for t in parts:
            chained = [(w + dw, out) for w, mid in chained for dw, out in t.paths(mid)]
        assert sorted(chained) == sorted(paths)


def test_small_transducers():
    flip = build(0, lambda s, x: [("b" if x == "a" else "a", 1.0, 1 - s)], "ab", lambda s: s == 0)
    assert flip.best("ab") == (2.0, ("b", "a")) and flip.best("a") is None and flip.best("") == (0.0, ())
    assert compose(flip, flip).best("abab") == (8.0, tuple("abab"))
    tie = Transducer([{"a": [("y", 1.0, 0), ("x", 1.0, 0)]}], {0})
    assert tie.best("aaa") == (3.0, ("x", "x", "x"))


def test_long_runs_change_nothing():
    g = toxicity.Matcher(toxicity.Grammar({"clown": 4.0}, {}))
    for gap in range(0, 14):
        text = " ".join(["you", *["so"] * gap, "clown", *["so"] * gap, "kill", *["so"] * gap, "them"])
        symbols = "Y" + "W" * gap + "I" + "W" * gap + "T" + "W" * gap + "Y"
        want = dict.fromkeys(toxicity.CHANNELS, 0.0)
        for o in by_hand(symbols):
            channel, times = toxicity.WRITTEN[o]
            want[channel] += times * (4.0 if o in "prtn" else 1.0)
        assert dict(zip(toxicity.CHANNELS, g.channels(text), strict=True)) == want
    long = "clown and you " * 30_000
    assert g.channels(long)[1] == 120_000
