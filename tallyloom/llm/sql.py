"""SQL that equals queries of this package, where SQL can express them."""

_PARTS = "array_to_string(list_sort(list_filter(string_split_regex(regexp_replace(lower(contributor_name), '[.''`‘’ʼ]', '', 'g'), '[^\\p{L}\\p{N}\\p{M}]+'), lambda x: x <> '')), ' ')"
_FOLDED = ", ".join(f"regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}}\\p{{M}}]+', '', 'g')" for c in ("contributor_employer", "contributor_occupation", "contributor_city"))
_RECEIPT = f"start_date, amount, transaction_type, recipient_committee_id, contributor_state, contributor_zip_code, {_FOLDED}, {_PARTS}"

P2_FOUND = f"""SELECT first_row_id, row_id AS copy_row_id FROM (
  SELECT row_id, min(row_id) OVER (PARTITION BY {_RECEIPT}) AS first_row_id FROM contributions WHERE amount IS NOT NULL)
WHERE row_id <> first_row_id"""

P2_COLLAPSED = f"""SELECT first_row_id, count(*) AS n_copies FROM (
  SELECT min(row_id) OVER (PARTITION BY {_RECEIPT}) AS first_row_id FROM contributions WHERE amount IS NOT NULL)
GROUP BY 1"""
