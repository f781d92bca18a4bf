"""The operators and builders at work on the star-schema test tables.

``queries`` holds one query per operator or builder, ``sql`` the same in SQL, and
``standins`` shapes the test tables like the raw feeds.
"""
