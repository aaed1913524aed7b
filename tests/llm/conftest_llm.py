#: Rows that every operator must take: nulls, empty and odd texts, repeated rows.
ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "word"), (4, "word"), (None, "no id"), (5, "Ünï çóde 😀 中文字 \x00 end"), (6, "x" * 5000), (7, "a b c d e f g"), (7, "a b c d e f g")]
