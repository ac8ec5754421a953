"""Plain versions of the operators, and documents that bring out their cases."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def made_up(n=60, seed=3, vocabulary=400):
    """Documents with copies, near copies, shared passages and lines, empty and null texts."""
    rnd = random.Random(seed)
    voc = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyzéß") for _ in range(rnd.randint(1, 7))) for _ in range(vocabulary)]
    passage = [rnd.choice(voc) for _ in range(45)]
    docs = []
    for i in range(n):
        kind = rnd.random()
        if docs and kind < 0.15:
            text = rnd.choice(docs)[1]
        elif docs and kind < 0.4 and (base := words(rnd.choice(docs)[1])):
            for _ in range(rnd.randint(1, 3)):
                base[rnd.randrange(len(base))] = rnd.choice(voc)
            text = " ".join(base)
        else:
            w = [rnd.choice(voc) for _ in range(rnd.choice([0, 1, 3, 4, 5, 19, 20, 21, 60, 150]))]
            if rnd.random() < 0.4:
                w[len(w) // 2 : len(w) // 2] = passage[rnd.randint(0, 10) : rnd.randint(25, 45)]
            text = "".join(x + rnd.choice([" ", " ", " ", "  ", "\n", "\t"]) for x in w)
            if rnd.random() < 0.4:
                text += "\n  Shared Line \n" if rnd.random() < 0.5 else "\nshared line"
        docs.append((i * 3 % 101, text))
    docs.append((200, None))
    docs.append((201, ""))
    docs.append((202, "ab " * 70))
    docs.append((203, " \n\t "))
    return docs


def components(ids, edges):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}
