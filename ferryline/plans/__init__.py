"""End-to-end flows, the query registry and its SQL counterparts."""
