"""Java regex classes that agree with Unicode-aware text rules.

Java's ``\\s``, ``\\w`` and ``trim`` only know ASCII; these do not.
"""

#: Everything that separates words visually, incl. the ASCII separators and every Unicode blank.
WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
#: The characters of that class, for trimming without a pattern.
BLANKS = (
    "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
)
#: A character of an identifier-like word.
WORD = r"[\p{L}\p{N}_]"
LETTER = r"\p{L}"
ALNUM = r"[\p{L}\p{N}]"
DIGIT = r"\p{Nd}"
