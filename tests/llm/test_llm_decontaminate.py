"""Edit matches against a full distance table."""

import random

from notegrove.llm.decontaminate import EDIT_RATE, Items, normal


def least_distance(item, text):
    """The least edits that turn the item into some passage of the text."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def edited(rnd, text, n):
    for _ in range(n):
        i = rnd.randrange(len(text))
        text = rnd.choice([text[:i] + text[i + 1 :], text[:i] + rnd.choice("abc ") + text[i:], text[:i] + rnd.choice("abc ") + text[i + 1 :]])
    return text


def test_against_a_distance_table():
    rnd = random.Random(8)
    words = ["ab", "abc", "cab", "bca", "a", "caab", "bb"]
    sentence = lambda n: " ".join(rnd.choices(words, k=n))
    hits = 0
    for _ in range(60):
        items = [(k, normal(sentence(rnd.randrange(6, 30)))) for k in range(4)]
        budget = {k: int(len(t) * EDIT_RATE) for k, t in items}
        block = Items(items, EDIT_RATE)
        for k, t in items:
            text = normal(sentence(12) + " " + edited(rnd, t, rnd.randrange(0, budget[k] + 3)) + " " + sentence(12))
            got = {items[m[0]][0]: m[1] for m in block.matches(text)}
            want = {i: least_distance(x, text) for i, x in items}
            assert got == {i: d for i, d in want.items() if d <= budget[i] and (budget[i] or f" {dict(items)[i]} " in f" {text} ")}
            hits += len(got)
    assert hits > 100
