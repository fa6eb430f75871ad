"""M21 against the rule in plain code over every set of views, threshold and verdict."""

import itertools

from pyspark.sql import functions as F

from tesserine.functions import metrics

VIEWS = ("front", "left", "back", "right", "top", "bottom")


def plain(scores, selects, strategy, threshold, judged):
    if not scores:
        return None
    slots, turns, up = dict.fromkeys(metrics.SLOTS), dict.fromkeys(metrics.SLOTS, 0), "top"
    if not selects:
        slots |= {s: s for s in metrics.SLOTS if s in scores}
        if not slots["front"]:
            slots["front"] = max(((v, scores[v]) for v in VIEWS if v in scores), key=lambda x: x[1])[0]
    elif strategy == "entropy_edge":
        top = scores.get("top", -1e9) - scores.get("front", -1e9) > threshold and judged is True
        if top:
            slots, turns, up = {"front": "top", "left": "left", "back": "bottom", "right": "right"}, {"front": 0, "left": 270, "back": 180, "right": 90}, "bottom"
        else:
            slots = {s: s for s in metrics.SLOTS}
    else:
        return None
    sides = [slots[s] for s in metrics.SLOTS[1:] if slots[s]]
    if any(v not in scores for v in sides) or not sides:
        return None
    return (slots, turns, up, len(sides) + 1)


def test_equals_plain_rule(spark):
    cases, faulty = [], []
    for n in range(7):
        for views in itertools.combinations(VIEWS, n):
            for k, (selects, strategy, judged) in enumerate([(False, "entropy_edge", None), (True, "entropy_edge", True), (True, "entropy_edge", None), (True, "legacy", True), (True, "entropy_edge", False)]):
                scores = {v: float((i * 7 + n * 3 + k) % 5) for i, v in enumerate(views)}
                case = (scores, selects, strategy, float(k % 3), judged)
                (faulty if plain(*case) is None else cases).append(case)
    assert len(cases) > 60 and len(faulty) > 60
    schema = "i int, scores map<string,double>, selects boolean, strategy string, threshold double, judged boolean"
    plan = metrics.view_plan(*[F.col(c) for c in ("scores", "selects", "strategy", "threshold", "judged")]).alias("p")
    for r in spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], schema).select("i", plan).collect():
        p = r["p"]
        assert (dict(p["slots"]), dict(p["turns"]), p["virtual_up"], p["input_count"]) == plain(*cases[r["i"]])
    for case in faulty[:: len(faulty) // 6]:
        try:
            spark.createDataFrame([(0, *case)], schema).select(plan).collect()
        except Exception as e:  # noqa: BLE001
            assert any(x in str(e) for x in ("no views", "side view", "two views", "unknown strategy"))
        else:
            raise AssertionError(case)
