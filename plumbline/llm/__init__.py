"""Operators for preparing large-scale language-model training data.

Nothing outside this subpackage imports it. Each module holds one operator with
its own general interface; ``queries`` wraps them as the ``opN_<name>`` queries.
"""
