"""A row-at-a-time statement of the span rules, to test the expressions against."""

from titlespan.types import ENTITY_TYPES


def spans(tokens, tags, mode, reference=None):
    found, members, kind = [], [], None

    def close():
        nonlocal members, kind
        if members:
            text = " ".join(tokens[i] for i in members)
            found.append((kind, members[0], members[-1], text))
        members, kind = [], None

    for i in range(min(len(tokens), len(tags))):
        tag = tags[i] or ""
        blank = (reference[i] or "") == "" if mode == "reference" else tag == ""
        if blank and mode == "lenient":
            close()
        elif blank:
            if members:
                members.append(i)
        elif tag == "O":
            close()
        elif tag.startswith("I-") and kind == tag[2:]:
            members.append(i)
        elif tag[:2] in ("B-", "I-"):
            close()
            members, kind = [i], tag[2:]
        elif mode == "strict":
            close()
    close()
    if mode == "lenient":
        found = [s for s in found if s[0] in ENTITY_TYPES]
    return found


def transitions(tags):
    """Positions of I-tags after an open span of another type."""
    found, kind = [], None
    for i, tag in enumerate(tags):
        tag = tag or ""
        if tag in ("", "O"):
            kind = None
        elif tag[:2] in ("B-", "I-"):
            if tag[0] == "I" and kind not in (None, tag[2:]):
                found.append(i)
            kind = tag[2:]
    return found
