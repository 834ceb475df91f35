"""Plain restatements shared by the tests of this folder."""

import re


def ascii_lower(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def words(text, pattern=r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"):
    return re.findall(pattern, ascii_lower(text))
