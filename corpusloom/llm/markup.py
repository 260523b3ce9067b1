"""What counts as a tag of markup in a text."""

from __future__ import annotations

import re

_ATTRIBUTE = r"""\s+[A-Za-z_:@][\w:.-]*+(?:\s*+=\s*+(?:"[^"<>]*+"|'[^'<>]*+'|[^\s<>"']++))?+"""
#: A name with attributes of any length between angle brackets; no part is read twice, so long texts take linear time.
TAG = re.compile(rf"</?+[A-Za-z][\w:-]*+(?:{_ATTRIBUTE})*+\s*+/?>")
