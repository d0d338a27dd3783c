"""Operators that prepare training text. Nothing outside this subpackage imports it.

Conventions of all its operators: a null text is an empty text; inputs may have
any further columns, under any names, since each operator reads only the columns
it names; an empty table gives an empty result of the same schema.
"""
