"""Test relations on the shared star schema, and the queries checked against SQL on them."""
