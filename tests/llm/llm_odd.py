"""Strings on which a tokenizer's steps meet."""

ODD_STRINGS = [
    "don't we'll I'M", "<|endoftext|> a <|ENDOFTEXT|>", "É́ é ÀÉß×÷ÿŸ", "a\xa0b c\x1cd\x85e", "İstanbul Σας ΣΑΣ", "œuvre Œ 1234 a1b2",
    "naïve–café’s “x”", "K K", "'s 't's", "a'b'll", "ＡＢ１２", "\x00\x01\x7f", "日本語 テキスト", "x" * 300, "é É",
]
