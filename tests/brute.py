"""SCD and as-of lookups by plain loops, the second opinion for the tests."""


def one_per_sequence(changes):
    """changes: dicts with k, seq, id. The largest id wins among equal (k, seq)."""
    best = {}
    for change in changes:
        at = (change["k"], change["seq"])
        if change["k"] is None or change["seq"] is None:
            continue
        if at not in best or change["id"] > best[at]["id"]:
            best[at] = change
    per_key = {}
    for change in best.values():
        per_key.setdefault(change["k"], []).append(change)
    return {k: sorted(v, key=lambda c: c["seq"]) for k, v in per_key.items()}


def scd2(changes, tracked, values, carry):
    out = []
    for k, history in one_per_sequence(changes).items():
        open_version, held = None, {c: None for c in values}
        for change in history:
            if change["op"] == "d":
                if open_version:
                    out.append({**open_version, "end": change["seq"]})
                open_version, held = None, {c: None for c in values}
                continue
            now = {c: change[c] for c in values}
            if carry:
                now = {c: held[c] if now[c] is None else now[c] for c in values}
                held = now
            if open_version and all(open_version[c] == now[c] for c in tracked):
                open_version.update(now)
            else:
                if open_version:
                    out.append({**open_version, "end": change["seq"]})
                open_version = {"k": k, **now, "start": change["seq"]}
        if open_version:
            out.append({**open_version, "end": None})
    return out


def as_of(facts, versions):
    """facts: (id, k, t); versions: (k, start, end, skey). Returns {id: skey}."""
    found = {}
    for fact_id, k, t in facts:
        hits = [s for vk, a, b, s in versions if vk == k and a <= t and (b is None or t < b)]
        assert len(hits) <= 1
        found[fact_id] = hits[0] if hits else None
    return found


def last_started(facts, versions):
    """The version that started last at or before t, if it hasn't ended; ties by end, then key."""
    found = {}
    for fact_id, k, t in facts:
        begun = [(a, b, s) for vk, a, b, s in versions if vk == k and a <= t]
        _, end, skey = max(begun, default=(None, None, None))
        found[fact_id] = skey if begun and t < end else None
    return found
