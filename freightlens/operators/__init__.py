"""Composite operators: the shipment spine, the wide mart, document links, data-quality rules and their results."""
