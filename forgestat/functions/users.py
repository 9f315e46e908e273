"""User classification."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values that must equal the reference's bot rule: substring patterns
# (LIKE, brackets literal) and exact logins, compared in lower case.
BOT_LIKE_PATTERNS = ("%bot%", "%[bot]%")
BOT_EXACT_LOGINS = ("dependabot", "github-actions", "renovate")


def is_bot_login(login: str | Column) -> Column:
    low = F.lower(F.col(login) if isinstance(login, str) else login)
    flag = low.isin(*BOT_EXACT_LOGINS)
    for pat in BOT_LIKE_PATTERNS:
        flag = low.like(pat) | flag
    # CASE ... ELSE false: a NULL login is not a bot.
    return F.coalesce(flag, F.lit(False))
