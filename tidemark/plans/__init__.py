"""End-to-end flows and the registered workloads with their SQL counterparts."""
