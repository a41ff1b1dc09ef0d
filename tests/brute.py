"""Plain Python statement of the truncation and loss rules, for small fixtures.

Works for any tokenizer: every candidate is rendered and counted as a whole.
"""

from __future__ import annotations

import hashlib

import regex

from turnloom.functions.tokens import TOKEN_PATTERN

SPLIT = regex.compile(TOKEN_PATTERN)


def encode(text):
    found = list(SPLIT.finditer(text))
    ids = [int(hashlib.md5(m.group().encode()).hexdigest()[:15], 16) for m in found]
    return ids, [m.span() for m in found]


EOS = encode("<|im_end|>")[0][0]


def render(messages, tools=None):
    out = []
    schemas = None if tools is None else f"# Tools\n<tools>\n{tools}\n</tools>"
    for i, m in enumerate(messages):
        body = m["content"]
        if m["role"] == "assistant" and m.get("reasoning"):
            body = f"<think>\n{m['reasoning']}\n</think>\n\n{body}"
        if i == 0 and schemas and m["role"] == "system":
            body = f"{body}\n\n{schemas}"
        elif i == 0 and schemas:
            out.append(f"<|im_start|>system\n{schemas}<|im_end|>\n")
        out.append(f"<|im_start|>{m['role']}\n{body}<|im_end|>\n")
    return "".join(out)


def fit(messages, limit, tools=None, enc=encode):
    def size(candidate):
        return len(enc(render(candidate, tools))[0])

    if not limit or size(messages) <= limit:
        return messages
    head = messages[:1] if messages[0]["role"] == "system" else []
    assistants = [i for i, m in enumerate(messages) if m["role"] == "assistant"]
    if not assistants:
        return messages
    start = max(len(head), assistants[-1] - 1)
    for first in range(len(head), start):
        candidate = head + messages[first:]
        if size(candidate) <= limit:
            return candidate
    kept = [dict(m) for m in head + messages[start:]]
    for m in kept:
        if m["role"] != "assistant" or not (m.get("reasoning") or "").strip():
            continue
        while m["reasoning"]:
            if size(kept) <= limit:
                return kept
            m["reasoning"] = m["reasoning"][: len(m["reasoning"]) // 2]
    return kept


def sample(messages, limit, tools=None, mode="all", side="left", roles=("assistant",), enc=encode, eos=EOS, fitted=None):
    fitted = fit(messages, limit, tools, enc) if fitted is None else fitted
    text = render(fitted, tools)
    in_loss = [False] * len(text)
    upto = 0
    for i, m in enumerate(fitted):
        begin, upto = upto, len(render(fitted[: i + 1], tools))
        if m["role"] not in roles:
            continue
        in_loss[begin:upto] = [True] * (upto - begin)
        span = text[begin:upto]
        a, b = span.find("<think>"), span.find("</think>")
        if mode != "all" and 0 <= a < b:
            if mode == "answer_only":
                masked = range(begin, begin + b + 8)
            else:
                masked = [*range(begin + a, begin + a + 7), *range(begin + b, begin + b + 8)]
            for c in masked:
                in_loss[c] = False
    ids, offsets = enc(text)
    labels = [t if any(in_loss[a:b]) else -100 for t, (a, b) in zip(ids, offsets)]
    full = len(ids)
    if limit and full > limit:
        if side == "left":
            ids, labels = ids[-limit:], labels[-limit:]
        else:
            ids, labels = ids[:limit], labels[:limit]
            if eos is not None and ids[-1] != eos:
                ids[-1], labels[-1] = eos, -100
    raw = len(enc(render(messages, tools))[0])
    return {"input_ids": ids, "labels": labels, "original_length": full, "raw_length": raw}


def random_conversations(rng, n, max_turns=9, words=12):
    """Conversations with every kind of role order, reasoning, blank reasoning and tags."""
    vocabulary = ["ab", "née", "7", ",", "\n", " ", "<think>", "</think>", "x" * 9, "本"]

    def text(top):
        return " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, top)))

    rows = []
    for key in range(n):
        messages = []
        for _ in range(rng.randint(1, max_turns)):
            role = rng.choice(["user", "assistant", "assistant", "tool", "system"])
            reasoning = rng.choice([None, "", "  ", text(words * 3), text(words)])
            messages.append({"role": role, "content": text(words) + ".", "reasoning": reasoning})
        rows.append((key, messages, rng.choice([None, '[{"name":"f"}]'])))
    return rows
