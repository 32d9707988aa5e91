"""Fits, statistics and fingerprints against plain loops that share no code with them."""

import math
import random
import zlib

import numpy as np
import xxhash

from pairtrace.llm import quality, simhash, toxicity


def plain_features(text):
    """Hash codes of words and word beginnings of a text, by character."""
    found, word = set(), b""
    for c in text.encode() + b" ":
        if chr(c).isascii() and not chr(c).isalnum():
            if word:
                found.add(word)
            word = b""
        else:
            word += bytes([c + 32 if 65 <= c <= 90 else c])
    return {zlib.crc32(x) & ((1 << toxicity.BITS) - 1) for w in found for x in (w, b"^" + w[:3], b"^" + w[:4], b"^" + w[:5])}


def plain_fit(positive, unlabelled, prior, rounds, rate, shrink, apart, sigmas):
    """Non-negative risk by dictionaries and one row at a time; the gradient by finite differences of the part that counts."""
    n_p, n_u = len(positive), len(unlabelled)
    kept = []
    for c in sorted(set().union(*positive, *unlabelled)):
        a, b = sum(c in x for x in positive) / n_p, sum(c in x for x in unlabelled) / n_u
        both = (a * n_p + b * n_u) / (n_p + n_u)
        if abs(a - b) >= max(apart, sigmas * math.sqrt(both * (1 - both) * (1 / n_p + 1 / n_u))):
            kept.append(c)
    weight, bias = dict.fromkeys(kept, 0.0), math.log(prior / (1 - prior))
    m, v = dict.fromkeys([*kept, None], 0.0), dict.fromkeys([*kept, None], 0.0)
    soft = lambda z: math.log1p(math.exp(z))
    for t in range(1, rounds + 1):
        margin = lambda x: bias + sum(weight[c] for c in x if c in weight)  # noqa: E731, B023
        zp, zu = [margin(x) for x in positive], [margin(x) for x in unlabelled]
        rest = sum(map(soft, zu)) / n_u - prior * sum(map(soft, zp)) / n_p
        grad = dict.fromkeys([*kept, None], 0.0)
        for x, z in zip(positive, zp, strict=True):
            s = 1 / (1 + math.exp(-z))
            g = (prior * (s - 1) - prior * s) / n_p if rest >= 0 else prior * s / n_p
            for c in [*(c for c in x if c in weight), None]:
                grad[c] += g
        for x, z in zip(unlabelled, zu, strict=True):
            s = 1 / (1 + math.exp(-z)) / n_u
            for c in [*(c for c in x if c in weight), None]:
                grad[c] += s if rest >= 0 else -s
        for c, g in grad.items():
            m[c], v[c] = 0.9 * m[c] + 0.1 * g, 0.999 * v[c] + 0.001 * g * g
            step = rate * (m[c] / (1 - 0.9**t)) / (math.sqrt(v[c] / (1 - 0.999**t)) + 1e-6)
            if c is None:
                bias -= step
            else:
                weight[c] = math.copysign(max(abs(weight[c] - step) - rate * shrink * 10, 0), weight[c] - step)
    return bias, {c: w for c, w in weight.items() if w}


def test_toxicity_fit_and_scores_equal_plain_loops():
    rnd = random.Random(1)
    say = lambda bad: " ".join(rnd.choice(("Good", "day", "über", "word", "same") + ("Slur!", "slurs", "foul") * bad) for _ in range(12))
    pos, unl = [say(1) for _ in range(30)], [say(i % 4 == 0) for i in range(60)]
    for text in [*pos[:3], "", "ÀB ab1_c  Ünï\tx"]:
        assert set(toxicity.codes(text).tolist()) == plain_features(text)
    for prior in (0.3, 0.9):  # with 0.9 the bracket turns negative and its gradient is reversed
        model = toxicity.fit([toxicity.codes(t) for t in pos], [toxicity.codes(t) for t in unl], prior, rounds=60, apart=0.05, sigmas=2.0)
        bias, weight = plain_fit([plain_features(t) for t in pos], [plain_features(t) for t in unl], prior, 60, 0.1, 2e-3, 0.05, 2.0)
        assert weight and math.isclose(model.bias, bias, rel_tol=1e-6) and set(model.code.tolist()) == set(weight)
        assert np.allclose(model.weight, [weight[c] for c in model.code.tolist()], rtol=1e-5, atol=1e-8)
        for text in (*pos[:4], *unl[:4], "", None):
            z = bias + sum(weight.get(c, 0) for c in plain_features(text or ""))
            assert math.isclose(model.score([text])[0], 1 / (1 + math.exp(-z)), rel_tol=1e-5)


def test_fingerprint_equals_counting_bits():
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice(("Aa", "b", "É", "é", "dd", "x.")) for _ in range(rnd.randrange(60))) for _ in range(80)]
    for text in [*texts, None, "", " \n\t", "One", "one TWO", "a b c d", "a\x0bb\x0cc  d\re", "a b c d e f"]:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for blank in "\t\n\x0b\x0c\r":
            lowered = lowered.replace(blank, " ")
        words = [w for w in lowered.split(" ") if w]
        shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
        ones = [0] * 64
        for s in shingles:
            h = xxhash.xxh64(s.encode(), seed=42).intdigest()
            for bit in range(64):
                ones[bit] += h >> bit & 1
        assert simhash.fingerprint(text) == sum(1 << bit for bit in range(64) if 2 * ones[bit] > len(shingles)), text


def test_statistics_equal_counting_by_hand():
    text = "Hello hello 12, HELLO|x!\nb. b. longest-word\x01\n\nHello hello 12, HELLO|x!"
    got = dict(zip(quality.STATISTICS, quality.statistics(text).tolist(), strict=True))
    words, n = text.split(), len(text)
    share = lambda test: sum(map(test, text)) / n
    lengths = [len(w) for w in words]
    pairs = list(zip(words, words[1:], strict=False))
    want = {
        "log_bytes": math.log1p(n), "log_words": math.log1p(11), "log_lines": math.log1p(4), "mean_word": sum(lengths) / 11, "longest_word": math.log1p(max(lengths)),
        "sd_word": math.sqrt(sum((x - sum(lengths) / 11) ** 2 for x in lengths) / 11), "upper": share(str.isupper), "digit": share(str.isdigit), "space": share(str.isspace),
        "bang": 2 / n, "pipe": 2 / n, "high_byte": 0.0, "control": 1 / n, "symbol": share(lambda c: c in ",|!.-"), "stop_marks": 4 / 11, "words_per_line": 11 / 4,
        "repeated_lines": 1 / 4, "distinct_words": len(set(words)) / 11, "top_word": 2 / 11, "distinct_bigrams": len(set(pairs)) / 10, "stutter": sum(a == b for a, b in pairs) / 10,
        "short_words": 2 / 11, "upper_words": sum(w[0].isupper() for w in words) / 11, "symbol_tail_words": sum(w[-1] in ",|!.-" for w in words) / 11,
    }
    assert set(want) == set(got) and all(math.isclose(got[k], want[k], abs_tol=1e-12) for k in want), {k: (got[k], want[k]) for k in want if not math.isclose(got[k], want[k], abs_tol=1e-12)}
    assert not quality.statistics("").any() and not quality.statistics(None).any()
