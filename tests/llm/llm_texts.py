import random


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    r = random.Random(seed)
    return " ".join(f"w{int(vocabulary * r.random() ** 2)}x" for _ in range(words))
