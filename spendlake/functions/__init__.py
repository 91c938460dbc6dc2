"""Builders of SQL expressions: text in, text out, for ``selectExpr`` and ``F.expr``.

Generated methods above 8000 bytes of bytecode are never JIT-compiled, so the
builders keep expressions small and mention each argument as rarely as possible.
"""
