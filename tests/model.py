"""A small pure-Python model of the path semantics, used as brute force."""

import json


def uri_of(e):
    if isinstance(e, str):
        return e
    if isinstance(e, dict):
        for k in ("uri", "@id"):
            if isinstance(e.get(k), str):
                return e[k]
    return None


def objects_at(doc, steps):
    cur = doc if isinstance(doc, list) else [doc]
    for k in steps:
        nxt = []
        for e in cur:
            if isinstance(e, dict) and e.get(k) is not None:
                v = e[k]
                nxt.extend(v) if isinstance(v, list) else nxt.append(v)
        cur = nxt
    return cur


def refs_at(doc, steps):
    return [u for u in map(uri_of, objects_at(doc, steps)) if u is not None]


def each(x, f):
    return [f(e) for e in x] if isinstance(x, list) else f(x)


def edit_at(v, steps, leaf):
    k, rest = steps[0], steps[1:]
    if not isinstance(v, dict) or k not in v:
        return v
    out = dict(v)
    out[k] = each(v[k], lambda e: edit_at(e, rest, leaf)) if rest else leaf(v[k])
    return out


def replace_refs(m, remove=()):
    def one(e):
        b = m.get(uri_of(e))
        if b is None:
            return e
        if not isinstance(e, dict):
            return b
        kept = {k: x for k, x in e.items() if k not in b and k not in remove}
        return {**kept, **b}

    return lambda x: each(x, one)


def distinct_elements(x):
    if not isinstance(x, list):
        return x
    seen, out = set(), []
    for e in x:
        s = json.dumps(e, sort_keys=True)
        if s not in seen:
            seen.add(s)
            out.append(e)
    return out


def merge(doc, steps, base, max_refs=None):
    refs = refs_at(doc, steps)
    if max_refs is not None:
        refs = refs[:max_refs]
    m = {r: base[r] for r in refs if r in base}
    return edit_at(doc, steps, replace_refs(m)) if m else doc


def link_merge(doc, steps, links, base, remove=()):
    """links: source uri -> base uri (one per source, identity links removed)."""
    m = {r: base[links[r]] for r in refs_at(doc, steps) if r in links and links[r] in base}
    return edit_at(doc, steps, replace_refs(m, remove)) if m else doc


def clean(doc, steps, base):
    usable = {k: v for k, v in base.items() if isinstance(v, dict) and v}
    return merge(doc, steps, usable)
