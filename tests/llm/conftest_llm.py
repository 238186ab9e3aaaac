"""Brute-force measures shared by the tests."""


def shingle_set(text, size=5):
    words = (text or "").lower().split()
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0
