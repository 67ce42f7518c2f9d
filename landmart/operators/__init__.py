"""DataFrame-to-DataFrame steps shared by the marts and the analyst queries.

Inputs follow the raw tables: owners(owner_name, parcel_id, is_real_property, pct_own,
account_type, file_index, ...) and parcels(parcel_id, area_m2, file_index, ...).
"""
